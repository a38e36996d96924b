import hashlib
import re

import pytest
import zstandard
from cases import awkward_texts, by_id, documents, no_rows, prose, saved

from riskweave.llm import middle_frames as m


def plain_middle(doc_id, text, rule=m.Rule()):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rule.percent:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < rule.spm_percent:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    lines = ["é😀\n" * 50, "\n\n\n", "a\nb", "a\nb\n", "no <S> mark\n", "<\nP>\n<", "<S\n<P\nM>x\n<", "\r\n\r", "x" * 3000 + "\n" + "日本" * 900, "\n".join(prose(i, 9) for i in range(400))]
    return awkward_texts() + lines


@pytest.mark.parametrize("frame_bytes", [8, 100, 65536])
def test_rows_equal_the_plain_version(spark, frame_bytes):
    docs = documents(spark, odd_texts()).withColumnRenamed("lang", "form").withColumnRenamed("source", "frames")
    plain = {r["doc_id"]: r["text"] for r in docs.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for rule in (m.Rule(), m.Rule(3, 50, 0)):
        got = by_id(m.fim_table(docs, rule, frame_bytes))
        texts = by_id(m.fim_texts(docs, rule, frame_bytes))
        assert len(got) == len(plain)
        for i, text in plain.items():
            n, form, prefix, middle, output = plain_middle(i, text, rule)
            assert got[i] == {
                "doc_id": i, "n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle,
                "output_sha256": sha(output), "restored_sha256": sha(text or ""),
            }
            assert (texts[i]["form_"], texts[i]["output"], texts[i]["frames"]) == (form, output, texts[i]["frames"])


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = saved(spark.createDataFrame([(1, "a\nb\n"), (1, "a\nb\n"), (None, "x\ny"), (None, None)], "doc_id long, text string"))
    rows = m.fim_table(docs).collect()
    assert len(rows) == 4 and len({tuple(r) for r in rows if r["doc_id"] == 1}) == 1
    assert {r["restored_sha256"] for r in rows if r["doc_id"] is None} == {hashlib.sha256(t).hexdigest() for t in (b"", b"x\ny")}
    assert m.fim_table(no_rows(spark)).count() == 0


class Counting:
    def __init__(self):
        self.inner, self.calls = zstandard.ZstdDecompressor(), 0

    def decompress(self, data):
        self.calls += 1
        return self.inner.decompress(data)


def test_a_cut_decompresses_its_own_frame_only():
    data = "".join(f"line {i} é\n" for i in range(20_000)).encode()
    frames = m.frames_of(data, 4096, zstandard.ZstdCompressor())
    assert len(frames) > 50 and b"".join(zstandard.ZstdDecompressor().decompress(f["data"]) for f in frames) == data
    counting = Counting()
    text = m.FramedText(frames, False, counting)
    for units in (0, 1, 77, 12_345, 20_000):
        counting.calls = 0
        at, chars = text.cut(units)
        assert counting.calls <= 1 and chars == len(data[:at].decode()) and data[:at].count(b"\n") == units
    assert b"".join(text.read(1000, 90_001)) == data[1000:90_001]


def test_the_text_is_rebuilt_from_the_output_alone():
    data = "prefix <\nS> m <P\nrest\n".encode()
    text = m.FramedText(m.frames_of(data, 8, zstandard.ZstdCompressor()), False, zstandard.ZstdDecompressor())
    for seed in range(40):
        output, _, _ = m.rearranged(text, seed, False, m.Rule(seed))
        found, size = m.marks_in(output.stream())
        assert size == len(data) + 9 and b"".join(m.restored(output, found, size)) == data
