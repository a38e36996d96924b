"""Token counts without token ids per document.

The tokenizer's splitting rule never joins a word with what follows the next white space, so a text
falls into pre-tokens whose pieces do not depend on their neighbours. A task takes a block of
documents, makes the list of distinct pre-tokens and the sparse matrix of how often each document has
each of them, lets the library count the pieces of every distinct pre-token once, joins the counts to
the frequencies and sums them per document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 16 << 20  # bytes of text whose distinct pre-tokens are held at a time

# White space as the splitting rule knows it (the Unicode property, without the separators U+001C to U+001F).
_SPACE = "\t-\r \x85\xa0  -     　"
# A word takes one space before it; a longer run of white space leaves its last space to the word.
PRE_TOKEN = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def check_tokenizer(path: str) -> None:
    """An error unless the file splits texts as `PRE_TOKEN` supposes, for else counts would be wrong in silence."""
    with open(path, encoding="utf-8") as f:
        settings = json.load(f)
    split = settings.get("pre_tokenizer") or {}
    model = settings["model"]
    wrong = [
        name for name, there in [
            ("a normaliser", settings.get("normalizer")),
            ("another split than ByteLevel with its rule", split.get("type") != "ByteLevel" or not split.get("use_regex", True)),
            ("a space put before texts", split.get("add_prefix_space")),
            ("another model than BPE", model.get("type", "BPE") != "BPE"),
            ("merges at random", model.get("dropout")),
            ("added tokens that strip or want whole words", any(
                t.get(k) for t in settings.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))),
        ] if there
    ]
    if wrong:
        raise ValueError(f"{path} has {', '.join(wrong)}; token_counts counts byte-level BPE files only")


class PieceCounter:
    """Piece counts of distinct pre-tokens, and the counts of documents made from them."""

    def __init__(self, tokenizer, specials: list[str]):
        self.tokenizer = tokenizer
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def frequencies(self, text: str, number: dict[str, int]) -> tuple[list[int], int]:
        """The numbers of the text's pre-tokens, new ones added to `number`, and its special tokens.

        As in the library, special strings are cut out of the text first, and each is one token.
        """
        parts = self.specials.split(text) if self.specials else [text]
        found = [number.setdefault(t, len(number)) for part in parts for t in PRE_TOKEN.findall(part)]
        return found, len(parts) - 1

    def pieces(self, distinct: list[str]) -> np.ndarray:
        out = np.zeros(len(distinct), np.int64)
        for at in range(0, len(distinct), 4096):
            encoded = self.tokenizer.encode_batch_fast(distinct[at : at + 4096], add_special_tokens=False)
            out[at : at + len(encoded)] = [len(e) for e in encoded]
        return out

    def count(self, texts: list[str | None]) -> np.ndarray:
        number: dict[str, int] = {}
        documents, columns, special = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found, special[i] = self.frequencies(text or "", number)
            which, times = np.unique(np.array(found, np.int64), return_counts=True)
            documents.append(np.full(len(which), i))
            columns.append(np.stack([which, times]))
        if not number:
            return special
        (which, times), per_piece = np.concatenate(columns, axis=1), self.pieces(list(number))
        # The join of (document, pre-token, frequency) with (pre-token, pieces), summed by document.
        return special + np.bincount(np.concatenate(documents), times * per_piece[which], len(texts)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, chars = [], 0
    for batch in batches:
        held.append(batch)
        chars += batch.nbytes
        if chars >= size:
            yield pa.Table.from_batches(held)
            held, chars = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _counting(path: str, limit: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        counter = PieceCounter(tokenizer, [t.content for t in tokenizer.get_added_tokens_decoder().values()])
        for table in _blocks(batches, block):
            texts = table["text"].to_pylist()
            tokens = counter.count(texts)
            sizes = [len(t.encode()) if t else 0 for t in texts]
            columns = [table["doc_id"].cast(pa.int64()).combine_chunks(), pa.array(sizes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)]
            yield from pa.table(columns, schema=_FIELDS).to_batches()

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text, without begin or end tokens.

    For byte-level BPE files of the `tokenizers` library with its usual splitting rule. The file must
    lie at the same place on all machines. Null texts count as empty (0 bytes, 0 tokens), repeated
    rows are counted each, an empty table gives none. Nothing is shuffled: the distinct pre-tokens of
    a block of `block_bytes` bytes stay in the task, which a longer text may exceed by itself. A file with
    other rules raises an error.
    """
    check_tokenizer(tokenizer_path)
    return docs.select("doc_id", "text").mapInArrow(_counting(tokenizer_path, limit, block_bytes), SCHEMA)
