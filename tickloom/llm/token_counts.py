"""Token counts of whole texts: lengths only, no ids leave the library.

A text is cut at safe boundaries, places that no token crosses and beyond which the
tokenizer does not look, so the counts of the runs between them add up to the count of the
whole.  For a byte-level file that is before a space or line end that follows other text; for a
sentencepiece file it is a single space between letters or digits, which the prefix that each
run gets stands for.  A file of another kind, where this is not known, gets whole texts.

Runs repeat, so each distinct run of a batch goes to the library once, in calls of about
CALL_BYTES, and a bounded table keeps the lengths.  A very long text is handled in portions.

Null texts count as empty, with 0 tokens; rows may repeat and ids may be null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices, table_batch, whole_text

#: Tokens above which a document is over the limit.
LIMIT = 1024
#: Text of one call of the library, and characters of a text that are cut into runs at a time.
CALL_BYTES = 1 << 20
PORTION = 1 << 20
#: Lengths kept in a worker's table, and the longest run kept.
KEPT_RUNS = 1_000_000
KEPT_LENGTH = 64

# White space in any of the libraries' sense; U+180E counted as such in older versions.
_SPACE = r"\s\u180e\u200b\ufeff"
_BEFORE_SPACE = re.compile(rf"(?<=[^{_SPACE}])(?=[ \n])")
_HIDDEN_SPACE = re.compile(rf"[{_SPACE}][ \n]|\0")
_BETWEEN_LETTERS = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)


class _Json:
    """A tokenizers file; special tokens' names inside texts as the library has it by default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        added = described.get("added_tokens") or []
        cutter = described.get("pre_tokenizer") or {}
        byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter["add_prefix_space"]
        apart = not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added)
        self.boundary = _BEFORE_SPACE if byte_level and apart and not described.get("normalizer") else None

    def runs(self, text: str) -> list[str]:
        if self.boundary is None:
            return [text]
        if _HIDDEN_SPACE.search(text):
            return self.boundary.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def lengths(self, runs: list[str]) -> list[int]:
        return list(map(len, self.library.encode_batch_fast(runs, add_special_tokens=False)))


class _Pieces:
    """A sentencepiece file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        leads = not any("▁" in p.lstrip("▁") for p in pieces)
        prefixed = self.library.encode("a", out_type=str)[0].startswith("▁")
        self.boundary = _BETWEEN_LETTERS if leads and prefixed else None

    def runs(self, text: str) -> list[str]:
        return [text] if self.boundary is None else self.boundary.split(text)

    def lengths(self, runs: list[str]) -> list[int]:
        return list(map(len, self.library.encode(runs, num_threads=1)))


class TokenCounter:
    """Counts tokens of texts; holds the table of one Python worker."""

    def __init__(self, path: str):
        self.file = _Pieces(path) if path.endswith(".model") else _Json(path)
        self.known: dict[str, int] = {}

    def _portions(self, text: str) -> Iterator[str]:
        start = 0
        while self.file.boundary is not None and len(text) - start > PORTION:
            cut = self.file.boundary.search(text, start + PORTION)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:]

    def _learn(self, runs: list[str]) -> None:
        batch, held = [], 0
        for run in runs:
            batch.append(run)
            held += len(run)
            if held >= CALL_BYTES:
                self.known.update(zip(batch, self.file.lengths(batch)))
                batch, held = [], 0
        if batch:
            self.known.update(zip(batch, self.file.lengths(batch)))

    def _settle(self, runs: list[str], sizes: list[int]) -> np.ndarray:
        """Tokens of consecutive groups of runs, ``sizes`` of them each."""
        if len(self.known) > KEPT_RUNS:
            self.known.clear()
        new = list({r for r in runs if r not in self.known})
        self._learn(new)
        counts = np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))
        for run in new:
            if len(run) > KEPT_LENGTH:
                del self.known[run]
        return np.add.reduceat(counts, np.cumsum([0, *sizes[:-1]]))

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        runs: list[str] = []
        sizes: list[int] = []
        owners: list[int] = []

        def settle() -> None:
            if owners:
                np.add.at(out, owners, self._settle(runs, sizes))
            for held in (runs, sizes, owners):
                held.clear()

        for i, text in enumerate(texts):
            for portion in self._portions(text):
                got = self.file.runs(portion)
                runs += got
                sizes.append(len(got))
                owners.append(i)
                if len(runs) >= PORTION:
                    settle()
        settle()
        return out


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The worker's counter of a file, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every text.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer)
        for batch in slices(batches):
            counts = tokens.count(batch["text"].to_pylist())
            yield table_batch(
                _OUT, doc_id=batch["doc_id"], n_bytes=batch["n_bytes"], n_tokens=counts, over_limit=counts > limit
            )

    text = whole_text()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
