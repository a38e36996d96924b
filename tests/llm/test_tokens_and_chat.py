import hashlib
import json

import public_tokenizers
import pytest
from cases import awkward_texts, by_id, documents, no_rows, saved
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskweave.llm import chat_format as chat
from riskweave.llm.token_counts import PieceCounter, check_tokenizer, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
COUNTER = PieceCounter(TOKENIZER, ["<|endoftext|>"])


def _plain(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    texts = awkward_texts() + ["a<|endoftext|>b <|endoftext|>", "<|endoftext|>" * 3, "it's  we'll\n\n  x", " \u2003 \x1c\x1d y \x85"]
    docs = documents(spark, texts).withColumnRenamed("lang", "n_tokens")
    plain = {r["doc_id"]: r["text"] for r in docs.collect()}
    for blocks in (1, 16 << 20):
        got = by_id(token_counts(docs, PATH, block_bytes=blocks))
        assert len(got) == len(plain)
        for i, t in plain.items():
            assert got[i] == {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": _plain(t), "over_limit": _plain(t) > 1024}
    assert token_counts(no_rows(spark), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sé1²½.,!<|>\n\t \r\x0b\x1c\x1f\x85\xa0\u2003\u3000\u200b日ा😀") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_text_counts_as_the_library_says(texts):
    assert COUNTER.count(texts).tolist() == [_plain(t) for t in texts]


CONV = "conv_id long, turn long, role string, text string"


def test_conversations_read_back_as_they_were(spark):
    tricky = "\\### Assistant: </turn> ok"
    odd = [tricky, None, "", "<turn user>x</turn>", "\\l \\\\l <image:0> \\", "line\r\n\x00é😀"]
    rows = [(c, t, ("assistant", "user", "tool>x<", None)[(c + t) % 4], odd[(c * 3 + t) % len(odd)]) for c in range(9) for t in range(c)]
    rows += [(None, 1, "assistant", "no id"), (77, 1, "user", "same turn"), (77, 1, "user", "same turn")]
    table = saved(spark.createDataFrame(rows, CONV).selectExpr("*", "'clash' AS formatted"))
    got = by_id(chat.conversation_digests(chat.formatted_turns(table)), "conv_id")
    assert len(got) == len({r[0] for r in rows})
    for conv in {r[0] for r in rows}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: r[0])
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.conversation_digests(chat.formatted_turns(no_rows(spark, CONV))).count() == 0


def test_typed_parts_become_numbered_placeholders(spark):
    blank = dict.fromkeys([f.name for f in chat.PART])
    parts = [
        blank | {"type": "text", "text": "see <image:9> "}, blank | {"type": "image", "uri": "s://a", "width": 56, "height": 29},
        blank | {"type": "audio", "uri": "s://b", "seconds": 2.5}, blank | {"type": "text", "text": "and"},
        blank | {"type": "document", "uri": "s://c", "pages": 3},
    ]
    schema = chat.T.StructType([
        chat.T.StructField("conv_id", chat.T.LongType()), chat.T.StructField("turn", chat.T.LongType()),
        chat.T.StructField("role", chat.T.StringType()), chat.T.StructField("parts", chat.T.ArrayType(chat.PART)),
    ])
    out = chat.formatted_turns(spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], schema)).collect()
    row = next(r for r in out if r["turn"] == 0)
    assert row["formatted"] == "<turn assistant>see \\limage:9> <image:0><audio:1>and<document:2></turn>"
    assert [(a["place"], a["type"], a["uri"], a["tokens"]) for a in row["attachments"]] == [
        (0, "image", "s://a", 4), (1, "audio", "s://b", 63), (2, "document", "s://c", 3072)
    ]
    role, back = chat.read_turn(row["formatted"], [a.asDict() for a in row["attachments"]])
    assert role == "assistant" and [p["type"] for p in back] == ["text", "image", "audio", "text", "document"]
    assert back[0]["text"] == "see <image:9> "


@given(st.text(st.sampled_from("\\lg<>/turn image:0")), st.text(st.sampled_from("\\lg<> x")))
def test_escaping_is_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text and "<" not in chat.escape(text)
    formatted = chat.format_turn(role, [{"type": "text", "text": text}])[0]
    back_role, parts = chat.read_turn(formatted, [])
    assert (back_role, "".join(p["text"] for p in parts)) == (role, text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a>b", "</turn>"]), st.text(st.sampled_from("\\lg<>/turn ")))), st.integers(1, 9))
def test_joined_conversations_are_split_at_their_marks(turns, cut):
    made = [chat.format_turn(role, [{"type": "text", "text": text}]) for role, text in turns]
    joined = "".join(m[0] for m in made)
    reader = chat.ConversationReader()
    found = [t for i in range(0, len(joined), cut) for t in reader.feed(joined[i : i + cut])]
    assert reader.close() == len(joined)
    assert [(chat.unescape(t.role), chat.unescape(t.body)) for t in found] == turns
    assert all(joined[t.start : t.end] == t.body for t in found)
    before = 0
    for (string, start, end, _), turn in zip(made, found):
        assert start is None or (before + start, before + end) == (turn.start, turn.end)
        before += len(string)


def test_broken_conversations_are_errors():
    for broken in ("x", "<turn user>a</turn>b", "</turn>", "<turn user</turn>"):
        with pytest.raises(ValueError):
            chat.ConversationReader().feed(broken)
    unfinished = chat.ConversationReader()
    unfinished.feed("<turn user>a")
    with pytest.raises(ValueError):
        unfinished.close()


def test_unknown_parts_are_an_error():
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"type": "video"}])


def test_a_tokenizer_with_other_rules_is_refused(spark, tmp_path):
    check_tokenizer(PATH)
    with open(PATH, encoding="utf-8") as f:
        rules = json.load(f)
    other = tmp_path / "other.json"
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"pre_tokenizer": {**rules["pre_tokenizer"], "add_prefix_space": True}}):
        other.write_text(json.dumps(rules | change))
        with pytest.raises(ValueError):
            token_counts(no_rows(spark), str(other))
