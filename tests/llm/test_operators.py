"""Each operator on small tables, against plain versions and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import (
    dart_minhash,
    fingerprints,
    html_text,
    licences,
    line_chunks,
    linking,
    mixing,
    packing,
    queries,
    token_files,
    topk,
    toxicity,
)
from tickloom.session import scratch_path

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators might use inside.
        T.StructField("key", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("tie", T.StringType()),
    ]
)
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))


def table(spark, rows, files=3):
    full = [(i, t, "en", s, len(t or ""), "k", "r", "s", "n", "t") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(files)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a very long text, ties and repeated rows."""
    rng = random.Random(9)
    base = words(rng, 300)
    rows = [(i, words(rng, rng.randint(1, 200)), f"s{i % 4}") for i in range(40)]
    rows += [(40, None, "s1"), (41, "", "s1"), (42, "  \n ", None), (43, base, None), (44, base, "s2")]
    rows += [(45, base + " tail", "s2"), (None, "null id " + words(rng, 30), "s3"), (None, None, None)]
    rows += [(46, words(rng, 30_000), "s0"), (47, "same row", "s1"), (47, "same row", "s1"), (48, "one", "")]
    return table(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_empty_tables(spark, empty, sf_dir):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, v array<long>")
    assert html_text.extract_main_text(pages).count() == 0
    assert fingerprints.fingerprint_documents(empty).count() == 0
    assert packing.pack_sequences(empty, BYTE).count() == 0
    assert dart_minhash.near_duplicates(empty).count() == 0
    assert dart_minhash.drop_near_duplicates(empty).columns == empty.columns
    assert topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0).count() == 0
    assert toxicity.score_documents(empty, labels).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mix_documents(empty).columns == empty.columns
    assert line_chunks.remove_repeated_chunks(empty).count() == 0
    assert licences.scan_licences(empty).count() == 0
    path = scratch_path(spark, "none")
    token_files.write_token_files(empty, path, WORD)
    assert token_files.read_token_files(spark, path).count() == 0


def test_pages_with_nulls_and_extra_columns(spark):
    rows = [(1, "u", "<p>a b</p>", 3), (1, "u", "<p>a b</p>", 3), (None, None, None, None), (2, None, "", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(html_text.extract_main_text(pages).collect(), key=str)
    want = [(1, "u", "a b", 3), (1, "u", "a b", 3), (2, None, "", 0), (None, None, "", 0)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def plain_fingerprints(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc, text, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest(), text, after))
    return out


def test_fingerprints_equal_a_plain_version(odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    got = rows_of(fingerprints.fingerprint_documents(odd))
    want = plain_fingerprints(rows)
    assert Counter((g["doc_id"], g["n_chars"], g["edited_sha256"]) for g in got) == Counter(w[:3] for w in want)
    by_key = {(g["doc_id"], g["n_chars"], g["edited_sha256"]): g for g in got}
    seen = {}
    for doc, n, sha, text, after in want:
        g = by_key[(doc, n, sha)]
        assert abs(g["near_next"] - fingerprints.jaccard(text, after)) < 0.2
        cut = text[: len(text) - n // 3] + after[: n // 3]
        assert abs(g["near_edited"] - fingerprints.jaccard(text, cut)) < 0.2
        assert seen.setdefault(text, g["fingerprint"]) == g["fingerprint"]
    assert {g["near_next"] for g in got if g["doc_id"] == 44} == {1.0}  # 43 has the same text


def test_one_document_is_its_own_next(spark):
    got = rows_of(fingerprints.fingerprint_documents(table(spark, [(5, "abcdef", "s")])))
    assert got[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and got[0]["near_next"] == 1.0


def test_packing_covers_every_id(odd):
    library = Tokenizer.from_file(BYTE)
    ids = defaultdict(list)
    for r in odd.collect():
        ids[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces = rows_of(packing.pack_sequences(odd, BYTE, group_tokens=4096))
    got = Counter()
    for p in pieces:
        data = [x[p["start"] : p["start"] + p["length"]] for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"]]
        assert p["ids_crc32"] in [zlib.crc32(np.array(d, "<u4").tobytes()) for d in data]
        got[p["doc_id"]] += p["length"]
    assert got == Counter({d: sum(map(len, x)) for d, x in ids.items()})
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at < 2048 and at & (at - 1) == 0


def test_token_files_round_trip(spark, odd):
    library = Tokenizer.from_file(WORD)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(odd, path, WORD, block_ids=500)
    got = rows_of(token_files.read_token_files(spark, path).orderBy("start"))
    at = 0
    want = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    for g, r in zip(got, want, strict=True):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        assert (g["doc_id"], g["start"], g["n_tokens"]) == (r.doc_id, at, len(ids))
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def plain_classes(rows, alike, threshold=0.8):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1] or "", rows[j][1] or ""
            if a == b or alike(a, b) >= threshold:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    out = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[(i, min(known) if known else None, len(ids))] += 1
    return out


def edits(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


@pytest.mark.parametrize("small", [2, 16])
def test_near_duplicates_equal_all_pairs(spark, odd, monkeypatch, small):
    """With small = 2, nearly all buckets are taken in blocks, as very large groups are."""
    monkeypatch.setattr(linking, "SMALL", small)
    monkeypatch.setattr(linking, "BLOCK", 8)
    rng = random.Random(11)
    base, passage = words(rng, 250), words(rng, 60)
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect() if len(r.text or "") < 10_000]
    rows += [(100 + i, edits(rng, base, i % 9), "s") for i in range(30)]
    rows += [(200 + i, passage + " " + words(rng, 25), "s") for i in range(40)]
    rows += [(300 + i, edits(rng, passage + " " + words(rng, 25), 2), "s") for i in range(5) for _ in range(2)]
    docs = table(spark, rows)
    for operator, alike in (
        (dart_minhash.near_duplicates, dart_minhash.weighted_jaccard),
        (fingerprints.similar_documents, fingerprints.jaccard),
    ):
        got = Counter((r.doc_id, r.class_id, r.class_size) for r in operator(docs).collect())
        assert got == plain_classes(rows, alike)


def test_drop_near_duplicates_keeps_one_of_each(odd):
    kept = dart_minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[47] == 1 and ids[43] == 1 and 44 not in ids and 45 not in ids and ids[None] == 2
    assert ids[40] == 1 and 41 not in ids and 42 not in ids  # texts without words


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(2)
    names = list(range(400))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(199)] + [(names[300], names[i]) for i in range(200, 300)]
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "a long, b long")
    got = {r.node: r.root for r in linking.components(df).collect()}
    for group in (names[:200], names[200:301]):
        assert {got[n] for n in group} == {min(group)}


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 5)], i) for i in range(120)]
    rows += [(120 + i, rows[0][1], 0) for i in range(30)]  # ties
    rows += [(200, None, 0), (201, [1.0, None, 0.0, 0.0, 0.0], 0), (202, [float("nan")] * 5, 0), (203, [float("inf")] * 5, 0)]
    rows += [(None, rows[0][1], 0), (40, rows[40][1], 0), (220, [0.5, 0.5], 0), (221, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    vectors = df.select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = defaultdict(list)
    for r in topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(64 * x)) for x in v]
    for q in [i for i in whole if i % 20 == 0]:
        near = sorted(
            (-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])
        )[:20]
        assert got.pop(q) == [(n + 1, i, -s) for n, (s, i) in enumerate(near)]
    assert not got


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(8)
    values = rng.integers(-30, 30, (500, 8))
    df = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(values)], "vec_id long, v array<long>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 5).collect()}
    for q in range(0, 500, 20):
        scores = values @ values[q]
        near = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [got[(q, n + 1)] for n in range(5)] == [(i, -s) for s, i in near]


def test_toxicity_learns_and_leaves_out(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        text = words(rng, 60).split()
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(60), rng.choice(["vilest", "scummy", "wretch"]) + rng.choice(["", "es", "ly"]))
        rows.append((i, " ".join(text), "s"))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(5000, None, "s"), (5001, "", "s"), (None, "vilest scummy wretch", "s"), (5002, "vilest " * 5000, "s")]
    labels += [(0, 1, 1), (99_999, 0, 1), (None, 1, 1), (2, None, None)]
    docs = table(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rows_of(toxicity.score_documents(docs, marks))
    assert len(got) == len(rows)
    by_id = {g["doc_id"]: g for g in got}
    known = [g for g in got if g["doc_id"] is not None and g["doc_id"] < 1200]
    wrong = [g for g in known if g["held_out"] and g["predicted"] != (g["doc_id"] % 6 == 0)]
    assert len(wrong) <= 2
    for g in got:
        assert 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5)
        crc = zlib.crc32(str(g["doc_id"]).encode()) % 5 if g["doc_id"] is not None else 1
        assert g["held_out"] == (crc == 0)
        for near in g["evidence"]:
            assert zlib.crc32(str(near).encode()) % 5 != 0
    assert by_id[None]["predicted"] == 1 and by_id[5002]["predicted"] == 1 and by_id[5001]["predicted"] == 0
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {g["doc_id"] for g in got if not g["predicted"]} | {None}


def test_held_out_labels_change_nothing(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, 20) + (" vilest" if i % 4 == 0 else ""), "s") for i in range(300)]
    docs = table(spark, rows)
    true = [(i, int(i % 4 == 0)) for i in range(300)]
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in true]
    scores = []
    for labels in (true, flipped):
        df = spark.createDataFrame(labels, "doc_id long, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, df).collect()))
    assert scores[0] == scores[1]


def test_one_class_of_labels(spark):
    docs = table(spark, [(1, "a b", "s"), (2, "c", "s")])
    none = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, none).collect()} == {0}


def plain_targets(sizes, repeats=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(repeats * sizes[s] for s in full)
        over = sum(weight[s] for s in names if s not in full)
        out = {s: float(repeats * sizes[s]) if s in full else left * weight[s] / over for s in names}
        more = {s for s in names if s not in full and out[s] > repeats * sizes[s] + 1e-9}
        if not more:
            return out
        full |= more


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_reaches_targets(spark, seed):
    rng = random.Random(seed)
    rows = []
    for s, n in ((None, 40), ("a", 400), ("b", 3), ("c", 60), ("d", 1), ("e", 200), ("", 30), ("\U0001f600", 50), ("�", 20)):
        rows += [(len(rows) + i, words(rng, rng.choice([0, 1, 5, 30, 80, 400])), s) for i in range(n)]
    docs = table(spark, rows)
    got = rows_of(mixing.mix(docs))
    again = rows_of(mixing.mix(docs.repartition(2)))
    assert {(g["doc_id"], g["taken"]) for g in got} == {(g["doc_id"], g["taken"]) for g in again}
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    want = plain_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for g in got:
        s = g["source"]
        assert g["size"] == len(rows[g["doc_id"]][1].split()) and g["source_size"] == sizes[s]
        assert g["target"] == pytest.approx(want[s])
        assert g["taken"] == g["copies"] * g["size"] <= 3 * g["size"]
        taken[s] += g["taken"]
        largest[s] = max(largest[s], g["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(1, largest[s] / 2)


def test_mix_of_odd_rows(odd):
    got = rows_of(mixing.mix(odd))
    assert len(got) == odd.count()
    assert all(g["taken"] == 0 for g in got if g["size"] == 0)
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    times = Counter((r.doc_id, r.source) for r in mixed.collect())
    for g in got:
        rows = 2 if g["doc_id"] == 47 else 1
        if g["doc_id"] is not None:
            assert times[(g["doc_id"], g["source"])] == rows * (g["copies"] if g["size"] else 1)


def test_pareto_order_follows_inclusion_shares(spark):
    """Over many documents of one size, each source's share is drawn, and no id is favoured."""
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(4000)]
    got = rows_of(mixing.mix(table(spark, rows)))
    for s, share in (("a", 2 / 3), ("b", 4 / 3)):
        mine = sorted((g["doc_id"], g["copies"]) for g in got if g["source"] == s)
        for part in (mine[:1000], mine[1000:]):
            assert abs(np.mean([c for _, c in part]) - share) < 0.06


def plain_line_dedup(rows, least=40):
    """The rule by itself: words of a run of 40 that stood before go, but for words of that place
    itself; lines without words left go."""
    seen, out = {}, {}
    for doc, text, _ in sorted(rows, key=lambda r: r[0]):
        lines = [line.split(" ") for line in (text or "").split("\n")]
        flat = [("\n" if i == 0 and n else " ") + w for n, line in enumerate(lines) for i, w in enumerate(line)]
        gone = set()
        for i in range(len(flat) - least + 1):
            run = "".join(flat[i : i + least])[1:]
            first, place = seen.setdefault(run, (doc, i))
            if (first, place) != (doc, i):
                gone.update(range(max(i, place + least) if first == doc else i, i + least))
        left, at = [], 0
        for line in lines:
            kept = [w for i, w in enumerate(line, at) if i not in gone]
            at += len(line)
            left += [" ".join(kept)] if kept else []
        out[doc] = "\n".join(left)
    return out


def gone_and_wanted(rows, got):
    """The share of the words the rule removes that are gone; no other word may be."""
    want = plain_line_dedup(rows)
    for doc, text in want.items():
        mine = iter(got[doc].split())
        assert all(word in mine for word in text.split())
    total = sum(len((t or "").split()) for _, t, _ in rows)
    gone, all_gone = (total - sum(len(t.split()) for t in texts.values()) for texts in (got, want))
    return gone / all_gone


def sentences(rng, n):
    return " ".join(words(rng, rng.randint(3, 12)).capitalize() + "." for _ in range(n))


def test_line_dedup_equals_a_plain_version(spark):
    rng = random.Random(13)
    passage, notice = sentences(rng, 9), "Licensed under the same words."
    listing = "\n".join(words(rng, 4) for _ in range(40))
    rows = []
    for i in range(60):
        parts = [sentences(rng, rng.randint(1, 6)) for _ in range(3)]
        if i % 5 == 0:
            parts.insert(i % 3, passage)
        if i % 7 == 0:
            parts.append(notice)
        if i % 11 == 0:
            parts.insert(1, listing)
        rows.append((i, "\n".join(parts), "s"))
    rows += [(60, rows[1][1], "s"), (61, None, "s"), (62, "", "s"), (63, sentences(rng, 2000), "s")]
    got = {r.doc_id: r for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    assert {d: r.text for d, r in got.items()} == plain_line_dedup(rows)
    assert passage in got[0].text and all(passage not in got[i].text for i in range(5, 60, 5))
    assert all(notice in got[i].text for i in range(0, 60, 7))
    assert got[60].text == "" and got[61].text == "" and got[61].removed_chunks == 0
    assert listing in got[0].text and got[11].text.count("\n") < 15
    clean = [i for i in range(60) if i % 5 and i % 7 and i % 11]
    assert all(got[i].text == rows[i][1] for i in clean)


def test_line_dedup_with_equal_hashes(spark, monkeypatch):
    """Chunks of different bytes under one hash are found by comparing bytes, and kept."""
    rng = random.Random(14)
    rows = [(i, sentences(rng, 12), "s") for i in range(6)]
    real = line_chunks.chunk_places

    def weak(found, least):
        at, hashes = real(found, least)
        return at, hashes * 0 + 5

    monkeypatch.setattr(line_chunks, "chunk_places", weak)
    got = {r.doc_id: r.text for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    assert got == {i: t for i, t, _ in rows}


def test_line_dedup_of_edited_copies(spark):
    """Copies with words changed, lines broken elsewhere, and a third of all rows under one passage."""
    rng = random.Random(19)
    rows, hot = [], sentences(rng, 10)
    for family in range(12):
        base = words(rng, 400).split(" ")
        for i in range(6):
            copy = [rng.choice(("\n", "x ")) + w if rng.random() < 0.01 else w for w in base]
            rows.append((family * 10 + i, " ".join(copy).replace(" \n", "\n"), "s"))
    rows += [(200 + i, f"{words(rng, 9)} {hot} {words(rng, 9)}", "s") for i in range(36)]
    got = {r.doc_id: r.text for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    assert gone_and_wanted(rows, got) > 0.97


def test_line_dedup_of_frequent_chunks(spark, monkeypatch):
    """Occurrences of a frequent hash do not meet in the shuffle by hash; the rows stay the same."""
    rng = random.Random(23)
    hot = words(rng, 60)
    rows = [(i, f"{words(rng, 50)} {hot if i % 4 else words(rng, 60)} {words(rng, 50)}", "s") for i in range(48)]
    rows += [(48 + i, t, "s") for i, (_, t, _) in enumerate(rows[:4])]
    want = {r.doc_id: r.text for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    met, firsts = [], line_chunks._firsts
    monkeypatch.setattr(line_chunks, "FREQUENT", 30)
    monkeypatch.setattr(line_chunks, "_firsts", lambda found, places: met.append(found) or firsts(found, places))
    got = {r.doc_id: r.text for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    assert got == want == plain_line_dedup(rows)
    rest, often = ([r["count"] for r in found.groupBy("hash").count().collect()] for found in met)
    assert max(rest) < 30 <= min(often)


def test_line_dedup_of_one_word_over_and_over(spark):
    rows = [(1, "la " * 300 + "end", "s"), (2, "start " + "la " * 200 + "tail", "s"), (3, "lo " * 39, "s"), (4, "lo " * 39, "s")]
    got = {r.doc_id: r for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    assert got[1].text.startswith("la " * 40) and got[1].text.endswith(" end") and len(got[1].text.split()) < 70
    assert got[2].text.split()[0] == "start" and got[2].text.split()[-1] == "tail" and len(got[2].text.split()) < 30
    assert got[3].text == got[4].text == "lo " * 39


def test_line_dedup_replaces_columns_named_like_its_own(spark):
    rng = random.Random(20)
    passage = words(rng, 60)
    docs = table(spark, [(1, passage, "s"), (2, "new\n" + passage, "s")]).withColumn("removed_chunks", F.lit("mine"))
    docs = docs.withColumn("Removed_Words", F.lit(7))
    got = line_chunks.remove_repeated_chunks(docs).orderBy("doc_id").collect()
    assert [(r.text, r.removed_chunks, r.removed_words) for r in got] == [(passage, 0, 0), ("new", 1, 60)]
    kept = line_chunks.drop_repeated_passages(docs)
    assert kept.columns == docs.columns
    assert [(r.n_chars, r.removed_chunks, r.Removed_Words) for r in kept.orderBy("doc_id").collect()] == [
        (len(passage), "mine", 7),
        (3, "mine", 7),
    ]


def test_line_dedup_of_passages_inside_paragraphs(spark):
    """Passages planted mid-line at any word go whole, with or without sentence marks."""
    rng = random.Random(17)
    rows, planted = [], []
    for n, size in enumerate((51, 60, 75, 100, 150) * 4):
        make = sentences if n % 2 else lambda r, k: words(r, 6 * k)
        passage = make(rng, 60).split()[3 : 3 + size]
        for i in range(3):
            before, after = (make(rng, 12).split()[rng.randint(1, 9) :] for _ in range(2))
            rows.append((3 * n + i, " ".join(before + passage + after), "s"))
            planted.append((" ".join(before + passage * (i == 0) + after), size * (i > 0)))
    rows.append((60, "one\n" + " ".join(rows[0][1].split()[4:120]) + "\ntwo", "s"))
    got = {r.doc_id: r for r in line_chunks.remove_repeated_chunks(table(spark, rows)).collect()}
    for i, (text, size) in enumerate(planted):
        assert (got[i].text, got[i].removed_words, got[i].removed_chunks > 0) == (text, size, size > 0)
    assert got[60].text == "one\ntwo" and {d: r.text for d, r in got.items()} == plain_line_dedup(rows)


def test_line_dedup_of_odd_rows(odd):
    got = line_chunks.remove_repeated_chunks(odd)
    assert got.columns == [*odd.columns, "removed_chunks", "removed_words"]
    assert got.count() == odd.count()


def test_licences(spark):
    mit = dict(licences.KNOWN)["Apache-2.0"]
    changed = "Copyright (c) 2020 A. Person\n" + licences.KNOWN[0][1].upper().replace(",", " ,\n") + "\n"
    rows = [
        (1, changed, "s"),
        (2, licences.KNOWN[0][1] + " and more", "s"),
        (3, "prose\nLICENCED under the MIT Licence\nthis work is licensed under the GNU general public license; version 3", "s"),
        (4, None, "s"),
        (5, "", "s"),
        (6, licences.KNOWN[6][1].replace("http:", "https:").replace("License", "Licence"), "s"),
        (6, mit, "s"),
    ]
    got = sorted((r.doc_id, r.licence or "", r.notices, r.notice_lines) for r in licences.scan_licences(table(spark, rows)).collect())
    assert got[0][:2] == (1, "MIT") and got[1][:2] == (2, "")
    assert got[2] == (3, "", "GPL-3.0-only,MIT", 2)  # "licenced" is spelled like "licensed"
    assert got[3] == (4, "", "", 0) and got[4] == (5, "", "", 0)
    assert got[5][1] == got[6][1] == "Apache-2.0"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_sql(spark, sf_dir, name):
    from check import compare

    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = db.execute(queries.oracle_sql()[name]).df()
    assert compare(queries.queries()[name](spark, sf_dir).toPandas(), want) == ""


def test_pipeline_equals_its_stages(spark, sf_dir):
    """Every stage against a plain version on the rows the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, before, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        had = [(r.doc_id, r.text, r.source) for r in before.collect()]
        if name == "packing":
            library = Tokenizer.from_file(BYTE)
            want = Counter()
            for doc, text, _ in had:
                want[doc] += len(library.encode(text, add_special_tokens=False).ids) + 1
            got = Counter()
            for p in after.collect():
                got[p.doc_id] += p.length
            assert got == want
            break
        assert after.columns == columns
        has = [(r.doc_id, r.text, r.source) for r in after.collect()]
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            scores = {r.doc_id: r.predicted for r in toxicity.score_documents(before, labels).collect()}
            assert sorted(has) == sorted(r for r in had if not scores[r[0]])
        elif name == "line dedup":
            assert gone_and_wanted(had, {d: t for d, t, _ in has}) > 0.98
        elif name == "near-dedup":
            classes = plain_classes(had, dart_minhash.weighted_jaccard)
            assert sorted(d for d, _, _ in has) == sorted(d for d, c, _ in classes if d == c)
        elif name == "mixing":
            times = {g["doc_id"]: g["copies"] if g["size"] else 1 for g in rows_of(mixing.mix(before))}
            assert Counter(d for d, _, _ in has) == Counter({d: n for d, n in times.items() if n})
        before = after
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
