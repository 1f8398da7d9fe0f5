"""Token ids of whole texts with a tokenizers-library file, at word speed.

Both kinds of file split a text at white space before merging, so a run of other characters
(with the one space before it) has ids that do not depend on its surroundings.  The library
encodes each run once; repeats come from a table of bounded size.  Texts with any white
space but single spaces and line ends go to the library whole, as do special tokens' names.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import regex

#: Runs kept in the table, and the longest kept run.
KEPT_RUNS = 1_000_000
KEPT_LENGTH = 64
END_ID = 1

#: White space other than the space and the line end, where a text is not cut into runs.
_ODD = [chr(c) for c in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010))]
_ODD += [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF, 0)]
_DOUBLE = ("  ", " \n", "\n\n", "\n ")


def _plain(text: str) -> bool:
    return not (text[-1:] in (" ", "\n") or any(x in text for x in _DOUBLE) or any(x in text for x in _ODD))


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _portions(runs: list[str]) -> Iterator[list[str]]:
    for start in range(0, len(runs), 4096):
        yield runs[start : start + 4096]


class RunEncoder:
    """Encodes texts; holds the run table of one Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described.get("added_tokens") or [] if t["content"]]
        plain = [t for t in described.get("added_tokens") or [] if not (t["normalized"] or t["lstrip"] or t["rstrip"])]
        self.apart = (plain[0]["content"], plain[0]["id"]) if plain else None
        self.lower = "Lowercase" in json.dumps(described.get("normalizer"))
        self.words = None
        names = self.library.get_vocab(with_added_tokens=False)
        self.starts_run = self.ends_word = None
        cutter = described.get("pre_tokenizer") or {}
        if cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not described.get("normalizer"):
            self.starts_run = self._marked(names, lambda t: t.startswith("\u0120"))  # a byte-level space
        elif described["model"].get("end_of_word_suffix") == "</w>":
            for part in cutter.get("pretokenizers", []):
                if part["type"] == "Split" and part["invert"] and part["behavior"] == "Removed":
                    self.words = regex.compile(part["pattern"]["Regex"])
                    self.ends_word = self._marked(names, lambda t: t.endswith("</w>"))
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self._forget()

    @staticmethod
    def _marked(names: dict[str, int], rule: Callable[[str], bool]) -> np.ndarray:
        out = np.zeros(max(names.values()) + 64, dtype=bool)
        out[[i for t, i in names.items() if rule(t)]] = True
        return out

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = array("I"), array("q"), array("q")

    def _add(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> int:
        """Appends runs to the table; the place of the first."""
        place, base = len(self.starts), len(self.flat)
        self.flat.frombytes(ids.astype(np.uint32).tobytes())
        self.starts.frombytes((starts + base).astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())
        return place

    def _whole(self, text: str) -> int:
        ids = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self._add(ids, np.zeros(1), np.array([len(ids)]))

    def _learn(self, runs: list[str]) -> None:
        """Encodes new runs, many in one call."""
        if self.starts_run is not None:
            spaced = [r for r in runs if r[0] == " "]
            for some in _portions(spaced):
                ids = self._ids("".join(some))
                self._put(some, ids, np.flatnonzero(self.starts_run[ids]), 0)
            runs = [r for r in runs if r[0] != " "]
        elif self.ends_word is not None:
            for some in _portions(runs):
                ids = self._ids(" ".join(some))
                words = np.cumsum([1 if r.isalpha() else len(self.words.findall(r)) for r in some])
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                if len(ends) == words[-1]:
                    self._put(some, ids, np.concatenate([[0], np.concatenate([[0], ends])[words[:-1]]]), 0)
                else:
                    self._learn_apart(some)
            return
        for some in _portions(runs):
            self._learn_apart(some)

    def _learn_apart(self, runs: list[str]) -> None:
        """Runs apart by a special token, where the library starts afresh."""
        if self.apart is None:
            self.known.update((r, self._whole(r)) for r in runs)
            return
        name, number = self.apart
        ids = self._ids(name.join(runs))
        self._put(runs, ids, np.concatenate([[0], np.flatnonzero(ids == number) + 1]), 1)

    def _put(self, runs: list[str], ids: np.ndarray, starts: np.ndarray, gap: int) -> None:
        """Run i has the ids from starts[i] to ``gap`` before the next start."""
        if len(starts) != len(runs):
            raise ValueError("the tokenizer joins or splits runs")
        ends = np.concatenate([starts[1:] - gap, [len(ids)]])
        place = self._add(ids, starts, ends - starts)
        self.known.update(zip(runs, range(place, place + len(runs))))

    def _ids(self, text: str) -> np.ndarray:
        (got,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(got.ids, dtype=np.uint32)

    def _parts(self, text: str) -> list[str] | None:
        if not text:
            return []
        if not _plain(text) or any(s in text for s in self.special):
            return None
        if self.lower and _latin(text):
            text = text.lower()
        if self.ends_word is not None:
            return text.split()  # white space has no ids
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return parts if parts[0] else parts[1:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (uint32) of each text."""
        if len(self.known) > KEPT_RUNS or len(self.flat) > 16 * KEPT_RUNS:
            self._forget()
        split = [self._parts(t) for t in texts]
        runs = [r for parts in split if parts is not None for r in parts]
        places = np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))  # -1: not yet known
        missing = np.flatnonzero(places < 0).tolist()
        new = list(dict.fromkeys(map(runs.__getitem__, missing)))
        self._learn(new)
        places[missing] = [self.known[runs[i]] for i in missing]
        runs_of = np.array([len(p) if p is not None else 1 for p in split])
        if odd := [i for i, p in enumerate(split) if p is None]:
            at = np.cumsum(runs_of)[odd] - 1 - np.arange(len(odd))
            places = np.insert(places, at, [self._whole(texts[i]) for i in odd])
        for run in new:
            if len(run) > KEPT_LENGTH:
                del self.known[run]
        return self._gather(places, runs_of)

    def _gather(self, places: np.ndarray, runs_of: np.ndarray) -> list[np.ndarray]:
        if not len(places):
            return [np.empty(0, np.uint32) for _ in runs_of]
        flat = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.empty(0, np.uint32)
        sizes = np.frombuffer(self.sizes, np.int64)[places]
        ends = np.cumsum(sizes)
        start = np.frombuffer(self.starts, np.int64)[places] - (ends - sizes)
        ids = flat[np.repeat(start, sizes) + np.arange(ends[-1])]
        last = np.cumsum(runs_of)
        cuts = np.concatenate([[0], ends])[last[:-1]]
        return np.split(ids, cuts)


_ENCODERS: dict[str, RunEncoder] = {}


def encoder(path: str) -> RunEncoder:
    """The worker's encoder of a file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = RunEncoder(path)
    return _ENCODERS[path]


def with_end(ids: list[np.ndarray]) -> list[np.ndarray]:
    """Each document's ids and the end id."""
    end = np.array([END_ID], np.uint32)
    return [np.concatenate([x, end]) for x in ids]
