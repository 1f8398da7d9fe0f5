"""Parts of the operators that need no Spark, against plain versions of themselves."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import dart_minhash, fingerprints, html_text, line_chunks, linking, packing, token_files, topk, toxicity
from tickloom.llm.tokens import RunEncoder, with_end

ODD_TEXTS = [
    "",
    " ",
    "\n",
    "\n\n\n",
    "a",
    "  two  spaces  ",
    "a\n\nb \nc\n d\n",
    "tab\tand\rreturn\x0bv\x0cf\x1cx\x85y\xa0z w　v﻿u",
    "don't I'LL we've 'S it''s ''t",
    "<|endoftext|> and <|startoftext|>x<|endoftext|>",
    "İstanbul ẞ KK é É́ ΣΣ Ǆ",
    "日本語 テキスト नमस्ते مرحبا \U0001f600\U0001f468‍\U0001f469",
    "x" * 300 + " " + "ab" * 200 + " c\x00d \x00",
    "###$$$ %%%a,b.c!? 12345 1,000.50 µªº×÷",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_run_encoder_equals_the_library(name):
    path = public_tokenizers.path(name)
    ours, library = RunEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    words = ["the", "Of", "ththor", "naïve", "straße,", "x.y", "(a)", "it's", "7%", "日本", "été"]
    joints = [" ", " ", " ", "\n", "  ", "\t", " \n", "\n\n"]
    texts = ODD_TEXTS + [
        "".join(rng.choice(words) + rng.choice(joints[: rng.choice([4, 8])]) for _ in range(rng.randint(1, 60)))
        for _ in range(300)
    ]
    for _ in range(2):  # the second time from the table
        for text, got in zip(texts, ours.encode(texts)):
            assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_run_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr("tickloom.llm.tokens.KEPT_RUNS", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    ours, library = RunEncoder(path), Tokenizer.from_file(path)
    for text in ["a b c d e", "f g h i j", "a b c"]:
        assert ours.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert with_end([np.array([5], np.uint32)])[0].tolist() == [5, 1]


@given(st.lists(st.integers(0, 1 << 62), max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert code.select_all().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        code.select(len(values))


def test_elias_fano_is_near_the_least_space():
    edges = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000))
    size = len(token_files.EliasFano.encode(edges).to_bytes()) * 8 / len(edges)
    assert size < 2.3 + np.log2(edges[-1] / len(edges)) < 64


@pytest.mark.parametrize("width", [2, 4])
def test_block_round_trip(width):
    ids = [np.array(x, np.uint32) for x in ([1], [7, 8, 1], [1], [65535, 2, 1])]
    docs = [None, -(1 << 63), 5, (1 << 63) - 1]
    block = token_files.Block(token_files.write_block(docs, ids, width))
    assert block.doc_ids() == docs
    assert [block.document(i).tolist() for i in range(4)] == [x.tolist() for x in ids]
    with pytest.raises(ValueError):
        token_files.Block(b"nope" + b"\0" * 60)


@given(st.lists(st.integers(1, 5000), min_size=1, max_size=60), st.sampled_from([8, 64, 2048]))
@settings(max_examples=80, deadline=None)
def test_assign_covers_every_id_without_padding(lengths, capacity):
    pieces = packing.assign(lengths, capacity)
    covered = {}
    for doc, start, n, seq, offset in pieces:
        assert n > 0
        covered.setdefault(doc, []).append((start, n))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(covered[doc]):
            assert start == at
            at += n
        assert at == length
    by_seq = {}
    for _, _, n, seq, offset in pieces:
        by_seq.setdefault(seq, []).append((offset, n))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == capacity or at < capacity and at & (at - 1) == 0


def test_assign_balances_cost():
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(20, 600, 3000)]
    cost = {}
    for _, _, n, seq, _ in packing.assign(lengths):
        cost[seq] = cost.get(seq, 0) + n + n * n / packing.BALANCE
    whole = len(packing.sequence_rooms(sum(lengths))) - bin(sum(lengths) % 2048).count("1")
    costs = np.array([cost[s] for s in range(whole)])
    order, in_order = rng.permutation(len(lengths)), []
    flat = np.concatenate([np.full(lengths[i], i) for i in order])
    for s in range(whole):
        _, n = np.unique(flat[s * 2048 : (s + 1) * 2048], return_counts=True)
        in_order.append((n + n * n / packing.BALANCE).sum())
    assert costs.std() < 0.5 * np.std(in_order)


ARTICLE = "The house of the man was in the town and it was a very old house that he had from his father. " * 3


def test_main_text_of_marked_and_unmarked_pages():
    page = f"""<html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
    <nav><a href=/>home</a></nav><header>Site of the town and the people in it, with all that is in it for you</header>
    <div class="cookie-notice"><p>{ARTICLE}</p></div><article><h1>A &amp; B</h1><p>{ARTICLE}<p>Short.<br>line
    <form><p>name</p></form><aside>{ARTICLE}</aside><p>caf&eacute; &#x41;</p></article>
    <section id="comments"><p>{ARTICLE}</p></section><footer>{ARTICLE}</footer></body>"""
    assert html_text.main_text(page) == "\n".join(["A & B", ARTICLE.strip(), "Short. line", "café A"])
    bare = f"""<div id=sidebar><p>{ARTICLE}</p></div><div><h2>Head</h2><p>{ARTICLE}</p><p>short tail</p>
    <p>{ARTICLE}</p></div><ul><li><a href=1>one two three</a><li><a href=2>four</a></ul>"""
    assert html_text.main_text(bare) == "\n".join(["Head", ARTICLE.strip(), "short tail", ARTICLE.strip()])


def test_main_text_of_cms_classes():
    body = f"<h1>Head</h1><p>{ARTICLE}</p><p>{ARTICLE}</p>"
    want = "\n".join(["Head", ARTICLE.strip(), ARTICLE.strip()])
    for start in (
        "<article class='post type-post category-social tag-search has-sidebar'>",
        "<article class='comment related'>",
        "<div id='page' class='widget-area content'><article>",
        "<div class='header-layout'><article>",
        "<div class='sidebar-layout no-sidebar'><div>",
        "<div class='social'><div>",
    ):
        assert html_text.main_text(f"<body><nav>menu</nav>{start}{body}</body>") == want
    for name in ("sidebar", "site-footer", "cookie-notice", "comments-area", "ad-slot-3", "share_buttons"):
        assert html_text.main_text(f"<body><div class='x {name}'><p>{ARTICLE}</p></div><div>{body}</div></body>") == want


def test_main_text_beside_teaser_articles():
    body = f"<h1>Head</h1><p>{ARTICLE}</p><p>{ARTICLE}</p><p>{ARTICLE}</p>"
    want = "\n".join(["Head", *[ARTICLE.strip()] * 3])
    teaser = f"<section><article><a href=/x><h3>Other post</h3><p>{ARTICLE}</p></a></article></section>"
    for start in ("main", "div"):
        assert html_text.main_text(f"<body><{start}>{body}</{start}>{teaser}</body>") == want
    plain = f"<article><p>{ARTICLE}</p></article>"
    assert want in html_text.main_text(f"<body><div>{body}</div>{plain}</body>")


def test_main_text_in_an_unlisted_language():
    text = "Вечером город затих, и только ветер шевелил листья старых лип вдоль набережной реки. " * 4
    page = f"<body><ul><li><a href='/'>Главная</a></ul><div><p>{text}</p><h2>Город</h2><p>{text}</p></div></body>"
    assert html_text.main_text(page) == "\n".join([text.strip(), "Город", text.strip()])
    few = "zx qv kj wb " * 20
    page = f"<article><p>{ARTICLE}</p><p>{few}</p><p>{ARTICLE}</p></article>"
    assert html_text.main_text(page) == "\n".join([ARTICLE.strip(), few.strip(), ARTICLE.strip()])


def test_main_text_of_odd_pages():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == ""
    assert html_text.main_text("<p>only this</p>") == "only this"
    assert html_text.main_text("<article>a < b <b>bold<p>x</b> y</article>") == "a < b bold\nx y"
    assert html_text.main_text("<article><p title='a>b'>q</p><!-- <p>no</p> --><p>r</article>") == "q\nr"
    assert html_text.main_text("<article><p>unclosed \"quote <i>x</i></p>") == 'unclosed "quote x'
    deep = "<div>" * 3000 + "<p>deep</p>"
    assert html_text.main_text(deep) == "deep"


def test_link_dense_blocks_and_neighbours():
    rules = html_text.Rules()
    block = html_text.Block("x" * 100, 50, False, 0, False)
    assert html_text.first_pass(block, 0, rules) is False
    assert html_text.second_pass([True, None, None, False], [True] * 4) == [True, True, False, False]
    assert html_text.second_pass([None, None], [True] * 2) == [True, True]
    assert html_text.second_pass([False, None, True], [False, True, True]) == [False, True, True]


def test_minhash_estimates_jaccard():
    rng = random.Random(5)
    a, b = fingerprints.permutations(512)
    words = [str(rng.randrange(10**6)) for _ in range(900)]
    for share in (0.0, 0.1, 0.5, 0.9, 1.0):
        other = words[: int(900 * share)] + [str(rng.randrange(10**6)) for _ in range(900 - int(900 * share))]
        one, two = " ".join(words), " ".join(other)
        s = fingerprints.signature(fingerprints.least(fingerprints.shingle_hashes(one), a, b))
        t = fingerprints.signature(fingerprints.least(fingerprints.shingle_hashes(two), a, b))
        assert abs(fingerprints.likeness(s, t) - fingerprints.jaccard(one, two)) < 0.09


def test_shingles_equal_a_plain_version():
    text = "Ab cd  ef\ngh ab CD ef gh ab"
    words = text.lower().split()
    plain = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hashes = fingerprints.shingle_hashes(text).tolist()
    assert len(hashes) == len(plain)
    assert [hashes.index(h) for h in hashes] == [plain.index(p) for p in plain]
    assert len(fingerprints.shingle_hashes("")) == 0 and len(fingerprints.shingle_hashes("a b")) == 1
    assert fingerprints.shingle_hashes("a b")[0] != fingerprints.shingle_hashes("b a")[0]
    long = "w" * 200_000 + " x"  # grows the table of powers
    assert len(fingerprints.word_hashes(long)) == 2


def test_darts_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    for change in (0, 20, 100, 200):
        y, w = x.copy(), rng.integers(1, 5, 200) + rng.random(200)
        y[:change] += np.uint64(1)
        v = w * rng.choice([1.0, 1.5], 200)
        least = np.minimum(w, v)[change:].sum()
        true = least / (w.sum() + v.sum() - least)
        agree = (dart_minhash.signature(x, w, 1024) == dart_minhash.signature(y, v, 1024)).mean()
        assert abs(agree - true) < 0.06


def test_weighted_jaccard_equals_a_plain_version():
    from collections import Counter

    def plain(s, t):
        def bag(text):
            w = text.lower().split()
            return Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or [tuple(w)])

        x, y = bag(s), bag(t)
        return sum((x & y).values()) / sum((x | y).values())

    rng = random.Random(1)
    for _ in range(50):
        s, t = (" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert dart_minhash.weighted_jaccard(s, t) == pytest.approx(plain(s, t))


def test_fold_tells_rows_apart():
    keys = linking.fold(np.array([[1, 2], [1, 2], [2, 1]], np.uint64))
    assert len(set(keys.tolist())) == 3


@pytest.mark.parametrize("scale", [5, 40, 10**6, 10**9])
def test_nra_equals_brute_force(scale):
    rng = np.random.default_rng(scale)
    values = rng.integers(-scale, scale, (400, 6))
    values[50:60] = values[0]
    ids = rng.permutation(400).astype(np.int64)
    got = list(zip(*topk.nra(ids[:30], values[:30], ids, values, 7)))
    want = []
    for q in range(30):
        scores = [(-sum(int(a) * int(b) for a, b in zip(values[q], values[c])), int(ids[c])) for c in range(400) if c != q]
        want += [(int(ids[q]), c, -s) for s, c in sorted(scores)[:7]]
    assert sorted(got) == sorted(want)


def test_nra_stops_early_on_easy_lists(monkeypatch):
    monkeypatch.setattr(topk, "FEW", 10)
    values = np.zeros((1000, 4), np.int64)
    values[:8] = 30
    depths = []
    real = topk.Lists.bounds
    monkeypatch.setattr(topk.Lists, "bounds", lambda self, depth, first: depths.append(depth) or real(self, depth, first))
    got = topk.nra(np.array([2]), values[2:3], np.arange(1000), values, 5)
    assert list(got[1]) == [0, 1, 3, 4, 5] and max(depths) < 1000


def line_words(*texts):
    return line_chunks.Words(pa.array(texts, pa.string()))


def test_words_are_places_in_the_bytes():
    words = line_words("two  words\n", "", "é\n\nÿ", "x")
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)] == ["two", "words", "é", "ÿ", "x"]
    assert words.text.tolist() == [0, 0, 2, 2, 3] and words.begin.tolist() == [0, 2, 2, 4, 5]
    assert words.breaks().tolist() == [True, False, True, True, True]
    assert len(line_words().starts) == len(line_words("", " \n").starts) == 0
    hashes = line_words("one two", "two one").hashes()
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] != hashes[0]
    whole = pa.array(["before", "two  words\n", "x"], pa.string()).slice(1, 1)
    assert bytes(line_chunks.Words(whole).data) == b"two  words\n"


def test_chunks_are_the_same_wherever_a_run_stands():
    rng = random.Random(16)
    run = [rng.choice("abcde") * rng.randint(1, 9) for _ in range(90)]
    for size in (40, 51, 90):
        for at in (0, 1, 17, 200):
            text = " ".join([rng.choice("abcde") * 3 for _ in range(at)] + run[:size] + ["z"] * 30)
            place, hashes = line_chunks.chunk_places(line_words("other words " * 50, text, " ".join(run)), 40)
            mine = set(hashes[(place >= 100 + at) & (place < 100 + at + size - 15)].tolist())
            assert mine & set(hashes[place >= 100 + at + size + 30].tolist())  # any 40 words hold a shared chunk
    assert len(line_chunks.chunk_places(line_words("la " * 39, "la " * 39), 40)[0]) == 0
    assert len(line_chunks.chunk_places(line_words("la " * 1000), 40)[0]) < 100


def test_words_equal_around_a_chunk():
    words = line_words("x a b c d e y")
    for chunk, before, span in (
        (b"c d e y", b"x a b ", (0, 7)),
        (b"c d ef", b"xx ab b ", (2, 5)),
        (b"c d e", b"a b ", (1, 6)),
        (b"c d\ne", b"zb ", (3, 5)),
        (b"q", b" ", (3, 3)),
    ):
        assert line_chunks.equal_words(words, 3, chunk, before, 40) == span


def test_text_without_words():
    words = line_words("a b c\n  d e\n\nf g\nh\n")
    for gone, left in (
        ("", "a b c\n  d e\n\nf g\nh\n"),
        ("b", "a c\n  d e\n\nf g\nh\n"),
        ("c", "a b\n  d e\n\nf g\nh\n"),
        ("a d", "b c\n  e\n\nf g\nh\n"),
        ("cdef", "a b\ng\nh\n"),
        ("de", "a b c\n\nf g\nh\n"),
        ("cde", "a b\n\nf g\nh\n"),
        ("abcdefg", "h\n"),
        ("abcdefgh", ""),
    ):
        mark = np.array([c in gone for c in "abcdefgh"])
        assert line_chunks.without(words, mark) == left
    assert line_chunks.without(line_words("a\nb"), np.array([False, True])) == "a"


def test_block_max_search_is_exact():
    rng = np.random.default_rng(6)
    matrix = np.where(rng.random((300, 20)) < 0.2, rng.random((300, 20)), 0).astype(np.float32)
    matrix = matrix[matrix.any(axis=1)]
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    ids = rng.permutation(len(matrix))
    index = toxicity.BlockMaxIndex.build(matrix, np.zeros(len(matrix), int), ids)
    for _ in range(40):
        term = np.sort(rng.choice(20, 3, replace=False))
        weight = rng.random(3).astype(np.float32)
        cosines = matrix[:, term] @ weight
        want = sorted((-round(float(c), 6), int(i)) for c, i in zip(cosines, ids) if c > 0)[:9]
        got = [(-c, i) for c, i, _ in index.nearest(term, weight, 9)]
        assert [c for c, _ in got] == pytest.approx([c for c, _ in want], abs=2e-6)


def test_crc_of_ids_is_little_endian():
    assert zlib.crc32(np.array([1], "<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0")
