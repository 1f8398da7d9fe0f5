"""The operators' queries over the given tables, and DuckDB SQL for those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    alignment,
    dart_minhash,
    fingerprints,
    html_text,
    licences,
    line_chunks,
    merkle,
    mixing,
    packing,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from tickloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark, sf_dir):
    return html_text.extract_main_text(_table(spark, sf_dir, "pages"))


def op2_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op3_pack_sequences(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_sequences(_table(spark, sf_dir, "documents"), path)


def op4_near_duplicates(spark, sf_dir):
    return dart_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels)


def op7_mix_sources(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_line_dedup(spark, sf_dir):
    cleaned = line_chunks.remove_repeated_chunks(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "removed_chunks", "removed_words")


def op9_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer)
    return token_files.read_token_files(spark, path)


def op10_licence_scan(spark, sf_dir):
    return licences.scan_licences(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(_table(spark, sf_dir, "documents")).drop("source")


def op12_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path)


def op13_tokenizer_alignment(spark, sf_dir):
    a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(_table(spark, sf_dir, "documents"), a, b)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_main_text,
    op2_fingerprints,
    op3_pack_sequences,
    op4_near_duplicates,
    op5_exact_top_k,
    op6_toxicity,
    op7_mix_sources,
    op8_line_dedup,
    op9_token_files,
    op10_licence_scan,
    op11_merkle_manifest,
    op12_token_counts,
    op13_tokenizer_alignment,
    pipeline,
)

_NEAR_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM documents
), shingled AS (
    SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE
        list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s FROM words
), counted AS (
    SELECT doc_id, coalesce(s, '') AS s, count(*) AS n FROM shingled GROUP BY ALL
), totals AS (
    SELECT doc_id, sum(n) AS total FROM counted GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS m
    FROM counted x JOIN counted y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), linked AS (
    SELECT a, b FROM shared JOIN totals p ON p.doc_id = a JOIN totals q ON q.doc_id = b
    WHERE m / (p.total + q.total - m) >= 0.8
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN linked l ON l.a = r.other
), classes AS (
    SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id
)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM classes
"""

_TOP_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), {_sql_text(licences.COPYRIGHT_LINE)}, '\\1', 'g')"
    for one, other in licences.SPELLINGS.items():
        out = f"replace({out}, {_sql_text(one)}, {_sql_text(other)})"
    return f"regexp_replace({out}, {_sql_text(licences.MARKS)}, ' ', 'g')"


def _digest_sql(lines: str) -> str:
    return f"sha256(trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g')))"


def _licence_sql() -> str:
    known = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in licences.KNOWN)
    return f"""
WITH known AS (
    SELECT {_digest_sql(_canonical_sql('t'))} AS d, min(licence) AS licence FROM (VALUES {known}) k(licence, t) GROUP BY 1
), canonical AS (
    SELECT doc_id, {_canonical_sql('text')} AS lines FROM documents
), digests AS (
    SELECT doc_id, lines, {_digest_sql('lines')} AS digest FROM canonical
), each_line AS (
    SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM canonical
), notices AS (
    SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices, count(*) AS notice_lines
    FROM (SELECT doc_id, {_digest_sql('line')} AS d FROM each_line) JOIN known USING (d) GROUP BY doc_id
)
SELECT digests.doc_id, digest, known.licence, coalesce(notices, '') AS notices,
    coalesce(notice_lines, 0) AS notice_lines
FROM digests LEFT JOIN known ON known.d = digest LEFT JOIN notices ON notices.doc_id = digests.doc_id
"""


#: Levels of a tree that the SQL unrolls: 3**13 leaves a source.
_MERKLE_LEVELS = 13


def _crc_sql(text: str) -> str:
    """Bytes of ASCII text, each followed by eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_prepend(ord(c), [-1, -1, -1, -1, -1, -1, -1, -1])))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}::BIGINT[]), lambda c, x: {step}), 4294967295)"


def _tree_sql(name: str, leaves: str, group: str) -> str:
    """CTEs of a forest: ``{name}_steps`` has, per leaf of ``leaves`` (group, place, h), its
    siblings and places level by level, and ``{name}_roots`` the root of each group."""
    out = [f"{name}0 AS (SELECT {group} AS g, place, h, count(*) OVER (PARTITION BY {group}) AS left_over FROM {leaves})"]
    for n in range(_MERKLE_LEVELS):
        out.append(
            f"{name}{n + 1} AS (SELECT *, count(*) OVER (PARTITION BY g) AS left_over FROM ("
            f"SELECT g, place // 3 AS place, sha256(string_agg(h, '' ORDER BY place)) AS h FROM {name}{n}"
            f" WHERE left_over > 1 GROUP BY g, place // 3"
            f" UNION ALL SELECT g, place, h FROM {name}{n} WHERE left_over = 1))"
        )
    runs = " UNION ALL ".join(
        f"SELECT g, {n} AS level, place // 3 AS run, list(h ORDER BY place) AS hs FROM {name}{n}"
        f" WHERE left_over > 1 GROUP BY g, place // 3"
        for n in range(_MERKLE_LEVELS)
    )
    out.append(f"{name}_runs AS ({runs})")
    out.append(
        f"{name}_steps AS (SELECT l.g, l.place, list({{'hs': hs, 'at': l.place // CAST(pow(3, level) AS BIGINT) % 3 + 1}}"
        f" ORDER BY level) AS steps FROM {name}0 l JOIN {name}_runs r ON r.g IS NOT DISTINCT FROM l.g"
        f" AND r.run = l.place // CAST(pow(3, level + 1) AS BIGINT) GROUP BY l.g, l.place)"
    )
    out.append(f"{name}_roots AS (SELECT g, h AS root FROM {name}{_MERKLE_LEVELS})")
    return ", ".join(out)


def _merkle_sql() -> str:
    def framed(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(framed(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    cut = "CASE WHEN even THEN replace(text, chr(10), '') ELSE text END"
    return f"""
WITH marked AS (
    SELECT *, coalesce({_crc_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0, false) AS even FROM documents
), leaves AS (
    SELECT doc_id, source, h, cut, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS place
    FROM (SELECT doc_id, source, {leaf('text')} AS h, {leaf(cut)} AS cut FROM marked)
), {_tree_sql('a', 'leaves', 'source')}, subroots AS (
    SELECT 0 AS everything, g AS source, root AS h, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS place FROM a_roots
), {_tree_sql('b', 'subroots', 'everything')}, joined AS (
    SELECT l.doc_id, l.h AS leaf, l.cut, s.h AS subroot, t.root,
        list_concat(coalesce(p.steps, []), coalesce(u.steps, [])) AS steps
    FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source CROSS JOIN b_roots t
    LEFT JOIN a_steps p ON p.g IS NOT DISTINCT FROM l.source AND p.place = l.place
    LEFT JOIN b_steps u ON u.place = s.place
), proofs AS (
    SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(flatten(list_transform(steps, lambda s: list_concat(s.hs[:s.at - 1], s.hs[s.at + 1:]))), '')) AS proof_sha256,
        list_reduce(list_prepend({{'hs': [cut], 'at': 1::BIGINT}}, steps), lambda f, s: {{'hs': [sha256(array_to_string(
            list_concat(list_append(s.hs[:s.at - 1], f.hs[1]), s.hs[s.at + 1:]), ''))], 'at': 1::BIGINT}}).hs[1] AS folded_root
    FROM joined
)
SELECT *, folded_root = root AS verified FROM proofs
"""


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": _NEAR_SQL,
        "op5_exact_top_k": _TOP_SQL,
        "op10_licence_scan": _licence_sql(),
        "op11_merkle_manifest": _merkle_sql(),
    }
