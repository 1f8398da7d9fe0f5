"""Merkle manifest, token counts and tokenizer alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tickloom.llm import alignment, merkle, queries, token_counts
from tickloom.llm.tokens import RunEncoder

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that operators use inside.
        *[T.StructField(c, T.StringType()) for c in ("slice", "row", "part", "place", "root", "entries", "a", "tie")],
    ]
)
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "\n",
    "a",
    " leading and trailing ",
    "two  spaces\n\nand lines \n x\n",
    "tab\tseparated\r\nlines",
    "special <|endoftext|> inside<|endoftext|>",
    "<s>not special</s> <unk> <0x41>",
    "‘quotes’ … é́   　 ﻿ ᠎ x​ y",
    "中文字 日本語\n한국어 emoji 👩‍👩‍👧 end",
    "▁ lower block ▁x",
    "don't we'll 's 1234567 3.14 !!! ??",
    "nul \0 byte",
    "x" * 3000,
    "ab " * 3000,
]


def table(spark, rows, files=3):
    return spark.createDataFrame([(*r, *["z"] * 8) for r in rows], DOCS).repartition(files)


def documents(rng, n, sources):
    out = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 6)))
        out.append((i * 7 % 1000, rng.choice(sources), rng.choice(["en", None]), len(text), text))
    return out


WORDS = ["the", "Therein", "lies", "étre", "que", "straße", "12", "x-ray", "naïve", "(so)", "end.", "tionsh"]


# --- manifest -----------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    doc, source, lang, n_chars, text = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)))


def plain_tree(nodes):
    """The root, and per leaf its runs level by level as (run, place)."""
    runs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        groups = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for leaf, i in enumerate(at):
            runs[leaf].append((groups[i // 3], i % 3))
        at = [i // 3 for i in at]
        nodes = [sha("".join(g)) for g in groups]
    return nodes[0], runs


def plain_manifest(rows):
    of = defaultdict(list)
    for r in rows:
        of[r[1]].append(r)
    order = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        held = sorted(of[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[s] = (held, *plain_tree([plain_leaf(r) for r in held]))
    root, tops = plain_tree([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        held, subroot, runs = trees[s]
        for r, own in zip(held, runs):
            steps = own + top
            proof = sha("".join(x for run, i in steps for k, x in enumerate(run) if k != i))
            node = plain_leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = plain_leaf((*r[:4], r[4].replace("\n", "")))
            for run, i in steps:
                node = sha("".join(node if k == i else x for k, x in enumerate(run)))
            out.append((r[0], plain_leaf(r), subroot, root, proof, node, node == root))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def check_manifest(spark, rows, depth, files=3):
    got = merkle.manifest(table(spark, rows, files), depth).drop("source").collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_manifest(rows), key=key)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_of_uneven_sources(spark, depth):
    """Small partitions, so that several rounds run and last subtrees are short."""
    rng = random.Random(depth)
    rows = documents(rng, 300, ["hot"] * 8 + [None, "b", "é", "z"])
    rows += [(i, f"host{i}", "en", 1, "x") for i in range(14)]
    check_manifest(spark, rows, depth)


@pytest.mark.parametrize("n", [1, 3, 4, 10, 28])
def test_manifest_at_the_edges_of_runs(spark, n):
    check_manifest(spark, [(i, "s", "en", 3, f"a\n{i}") for i in range(n)], 1)


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None)] * 7 + [(5, "s", None, 1, "line\n")] * 40
    rows += [(i, "", "en", None, t) for i, t in enumerate(ODD)] + [(-3, "s", "", 0, ""), (5, "s", None, 1, "other\n")]
    check_manifest(spark, rows, 1, files=5)
    assert merkle.manifest(table(spark, [], 1)).count() == 0


def test_manifest_verifies_what_is_untouched(spark):
    rows = [(i, "s", "en", 3, "no line end") for i in range(50)] + [(i + 50, "s", "en", 3, "a\nb") for i in range(50)]
    got = {r["doc_id"]: r["verified"] for r in merkle.manifest(table(spark, rows)).collect()}
    assert got == {i: i < 50 or zlib.crc32(str(i).encode()) % 2 == 1 for i in range(100)}


# --- token counts -------------------------------------------------------------------


def plain_counts(path, texts):
    if path.endswith(".model"):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(library.encode(t or "")) for t in texts]
    library = Tokenizer.from_file(path)
    return [len(library.encode(t or "", add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD, PIECE])
@pytest.mark.parametrize("portion", [7, 1 << 20])
def test_counts_are_the_librarys(spark, monkeypatch, path, portion):
    monkeypatch.setattr(token_counts, "PORTION", portion)
    monkeypatch.setattr(token_counts, "CALL_BYTES", 50)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "中", "'s", "12", "<|endoftext|>", "᠎", " ", "▁", ".", "́"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    assert token_counts.TokenCounter(path).count([t or "" for t in texts]).tolist() == plain_counts(path, texts)


def test_counts_of_a_table(spark):
    rows = [(i, "s", "en", 1, t) for i, t in enumerate(ODD)] + [(None, "s", "en", 1, "again"), (3, "s", "en", 1, "again")]
    rows += [(99, "s", "en", 1, "word " * 1024), (98, "s", "en", 1, "word " * 1023 + "word")]
    got = sorted(map(tuple, token_counts.count_tokens(table(spark, rows), BYTE).collect()), key=key)
    want = plain_counts(BYTE, [r[4] for r in rows])
    plain = [(r[0], len((r[4] or "").encode()), n, n > 1024) for r, n in zip(rows, want)]
    assert got == sorted(plain, key=key)
    assert {r[0]: r[3] for r in got if r[0] in (98, 99)} == {98: False, 99: True}
    assert token_counts.count_tokens(table(spark, [], 1), BYTE).count() == 0


def test_known_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_RUNS", 5)
    counter = token_counts.TokenCounter(BYTE)
    texts = [f"word{i} and{i}" for i in range(40)]
    assert [counter.count([t])[0] for t in texts] == plain_counts(BYTE, texts)
    assert len(counter.known) <= 8


# --- alignment ----------------------------------------------------------------------


def plain_bytes():
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, n = {chr(b): b for b in prints}, 0
    for b in range(256):
        if b not in prints:
            letters[chr(256 + n)] = b
            n += 1
    return letters


def plain_alignment(texts):
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    letters = plain_bytes()
    rows = []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            rows.append((0, 0, 0, [], ""))
            continue
        owner = [[k for k, x in enumerate(side) for _ in x] for side in (bytes_a, bytes_b)]
        links = sorted({(x, y) for x, y in zip(*owner)})
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (bytes_a, bytes_b)]
        cuts, parts, start = sorted(ends[0] & ends[1]), [], 0
        for cut in cuts:
            sides = [dict.fromkeys(o[start:cut]) for o in owner]
            parts.append(",".join(str(ids_a[k]) for k in sides[0]) + "|" + ",".join(str(ids_b[k]) for k in sides[1]))
            start = cut
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        rows.append((len(ids_a), len(ids_b), len(cuts), pairs, sha(";".join(parts))))
    count, held = Counter(p for r in rows for p in r[3]), Counter(p for r in rows for p in set(r[3]))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return (count, held), [
        (n_a, n_b, groups, len(pairs), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), digest)
        for n_a, n_b, groups, pairs, digest in rows
    ]


def aligned_texts():
    rng = random.Random(5)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    return ODD + made + ["the the the the"] * 30 + ["Therein lies " * 40]


@pytest.mark.parametrize("rows_a_slice,piece", [(1 << 16, 1 << 16), (10, 50)])
def test_alignment_is_the_plain_one(spark, rows_a_slice, piece):
    texts = aligned_texts()
    data = table(spark, [(i, "s", "en", 1, t) for i, t in enumerate(texts)])
    got = alignment.align_documents(data, BYTE, PIECE, piece, rows_a_slice).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain_alignment(texts)[1]
    assert [r["doc_id"] for r in got] == list(range(len(texts)))


def test_pair_counts_and_documents(spark):
    texts = aligned_texts()
    made = alignment.align_rows(table(spark, [(i, "s", "en", 1, t) for i, t in enumerate(texts)]), BYTE, PIECE)
    got = {(r["a"], r["b"]): r for r in alignment.pair_scores(made.where("planes IS NOT NULL")).collect()}
    (count, held), _ = plain_alignment(texts)
    assert {p: r["n_links"] for p, r in got.items()} == dict(count)
    assert {p: r["n_docs"] for p, r in got.items()} == dict(held)


def test_alignment_of_repeated_and_missing_rows(spark):
    rows = [(None, "s", "en", 1, "one text"), (None, "s", "en", 1, None), (4, "s", "en", 1, "one text"), (4, "s", "en", 1, "other")]
    got = alignment.align_documents(table(spark, rows), BYTE, PIECE).collect()
    want = plain_alignment([r[4] for r in rows])[1]
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *w) for r, w in zip(rows, want)), key=key)
    assert alignment.align_documents(table(spark, [], 1), BYTE, PIECE).count() == 0


@pytest.mark.parametrize("rows", [1, 7, 8, 9, 300, 5000])
def test_planes_round_trip(rows):
    rng = np.random.default_rng(rows)
    groups = [np.flatnonzero(rng.random(rows) < p) for p in (0, 0.003, 0.05, 0.5, 1)]
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    planes = alignment.encode_planes(group, np.concatenate(groups), len(groups), rows)
    owner, row = alignment.decode_planes(planes, rows)
    assert sorted(zip(owner.tolist(), row.tolist())) == list(zip(group.tolist(), np.concatenate(groups).tolist()))
    documents, links = alignment.popcounts([[planes[2], planes[3], planes[4]], [planes[1]]], np.array([rows, rows]))
    assert documents[0] == rows and documents[1] == len(groups[1])
    assert links[0] == len(groups[2]) + 2 * len(groups[3]) + 4 * rows


def test_queries_cover_their_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    for query in (queries.op11_merkle_manifest, queries.op12_token_counts, queries.op13_tokenizer_alignment):
        got = query(spark, sf_dir)
        assert got.count() == n and got.select("doc_id").distinct().count() == n
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    aligned = queries.op13_tokenizer_alignment(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in aligned] == plain_alignment(texts)[1]
    counts = queries.op12_token_counts(spark, sf_dir).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in counts] == plain_counts(BYTE, texts)
    assert spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id").isNull()).count() == 0


def test_runs_of_a_word_file_have_no_spaces():
    """One entry of the table for a word wherever it stands, and none for line ends."""
    enc = RunEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one two\nthree", " two one three", "three\n\none", "", "two one"]
    want = [enc.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert sorted(enc.known) == ["one", "three", "two"]
