"""Registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, exact_dedup, langid, licenses, manifest, mixing, near_dedup, repeats, secrets, spelling, topk, toxicity, warc
from folioforge.llm.common import table


def vocabulary() -> str:
    """Path of the public vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), near_dedup.Near(words=3, percent=85))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tamper_report(table(spark, sf_dir, "documents"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_bpe": op3_bpe,
    "op4_licenses": op4_licenses,
    "op5_warc": op5_warc,
    "op6_secrets": op6_secrets,
    "op7_topk": op7_topk,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle": op11_merkle,
    "op12_repeats": op12_repeats,
    "op13_spelling": op13_spelling,
}

#: CTE with the 256 entries of the CRC-32 table, by its rule.
_CRC_TABLE = """crc AS (
            SELECT list(v ORDER BY i) AS t
            FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
        )"""


def _crc(text: str) -> str:
    """SQL for the CRC-32 of a text's UTF-8 bytes; ``crc`` is joined."""
    digits = f"hex(encode({text}))"
    byte = f"list_transform(range(0, len({digits}), 2), lambda i: ('0x' || {digits}[i + 1:i + 2])::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"


def _row_digest(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _tree(name: str, leaves: str, grp: str) -> str:
    """CTEs of a tree over (grp, idx, n, h): its nodes, and what stands before and after each node in its run."""
    return f"""
        {name} AS (
            SELECT {grp} AS grp, 0 AS lvl, idx, n, h FROM {leaves}
            UNION ALL
            SELECT grp, lvl + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 3
        ),
        {name}_runs AS (
            SELECT a.grp, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
            FROM {name} a JOIN {name} b ON a.grp = b.grp AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL
        )"""


def _manifest_sql() -> str:
    def up(name: str, start: str, runs: str) -> str:
        return f"""
        {name} AS (
            SELECT k, grp, 0 AS lvl, idx, proof, f FROM {start}
            UNION ALL
            SELECT u.k, u.grp, u.lvl + 1, u.idx // 3, proof || before || after, sha256(before || f || after) FROM {name} u JOIN {runs} r ON r.grp = u.grp AND r.lvl = u.lvl AND r.idx = u.idx
        ),
        {name}_end AS (SELECT k, arg_max(grp, lvl) AS grp, arg_max(proof, lvl) AS proof, arg_max(f, lvl) AS f FROM {name} GROUP BY k)"""

    copy = f"CASE WHEN {_crc('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        d AS (SELECT doc_id, coalesce('=' || source, '-') AS grp, {_row_digest('text')} AS h, {_row_digest(f'({copy})')} AS seen FROM documents, crc),
        leaves AS (SELECT *, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n, row_number() OVER () AS k FROM d WINDOW w AS (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h)),
        {_tree('nodes', 'leaves', 'grp')},
        subroots AS (SELECT grp AS name, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
        {_tree('upper', 'subroots', "''")},
        {up('low', "(SELECT *, '' AS proof, seen AS f FROM leaves)", 'nodes_runs')},
        {up('high', "(SELECT k, '' AS grp, idx, proof, f FROM low_end JOIN subroots ON name = grp)", 'upper_runs')}
        SELECT doc_id, leaves.h AS leaf, subroots.h AS subroot, upper.h AS root, sha256(high_end.proof) AS proof_sha256, high_end.f AS folded_root, high_end.f = upper.h AS verified
        FROM leaves JOIN subroots ON name = leaves.grp JOIN high_end ON high_end.k = leaves.k JOIN upper ON upper.n = 1
    """


def _spelling_sql() -> str:
    run = f"translate(r, '{spelling.UPPER}', '{spelling.LOWER}')"
    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        r AS (SELECT doc_id, {run} AS run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 6 GROUP BY ALL),
        h AS (SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, crc),
        c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
        w AS (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
        one AS (SELECT DISTINCT cut.word AS longer, w.word AS shorter FROM cut JOIN w ON w.word = cut.rest),
        near AS (
            SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT longer, shorter FROM one UNION SELECT shorter, longer FROM one
        ),
        best AS (SELECT near.word, count(*) AS n_near, arg_min(o.word, (-o.n, o.word)) AS other, max(o.n) AS other_n FROM near JOIN w o ON o.word = near.other GROUP BY near.word),
        f AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
            FROM w LEFT JOIN best ON best.word = w.word
        ),
        chain AS (SELECT word, word AS top FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.top WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, chain.top AS root, f.n, f.n_near, f.form_n FROM f JOIN chain ON chain.word = f.word JOIN f z ON z.word = chain.top AND z.form IS NULL
    """


#: Windows are cut out of blocks, as a substring far into a text costs the way there.
_REPEATS_SQL = """
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    b AS (SELECT k, pos, substr(x, 2 * pos + 1, 2 * 1423) AS part, least(1024, len(x) // 2 - 399 - pos) AS n FROM (SELECT *, unnest(range(0, greatest(0, len(x) // 2 - 399), 1024)) AS pos FROM d)),
    s AS (SELECT k, pos + i AS p, md5_number(substr(part, 2 * i + 1, 800)) AS h FROM (SELECT *, unnest(range(n)) AS i FROM b)),
    twice AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
    hit AS (SELECT k, p, coalesce(p > lag(p) OVER (PARTITION BY k ORDER BY p) + 400, true) AS leads FROM s SEMI JOIN twice USING (h)),
    run AS (SELECT k, p, sum(leads::INT) OVER (PARTITION BY k ORDER BY p) AS run FROM hit),
    span AS (SELECT k, min(p) AS low, max(p) + 400 AS high FROM run GROUP BY k, run),
    part AS (
        SELECT k, low, high, coalesce(lag(high) OVER (PARTITION BY k ORDER BY low), 0) AS since FROM span
        UNION ALL SELECT k, NULL, NULL, max(high) FROM span GROUP BY k
    ),
    kept AS (SELECT d.k, string_agg(substr(x, 2 * since + 1, 2 * (coalesce(low, len(x) // 2) - since)), '' ORDER BY since) AS y, sum(coalesce(high - low, 0)) AS gone, count(low) AS spans FROM d JOIN part ON part.k = d.k GROUP BY d.k)
    SELECT doc_id, len(x)::BIGINT // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(y, x))) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.k = d.k
"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
            FROM pages
        )
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> winner THEN winner END AS refers_to
        FROM p
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op9_mixing": """
        WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        t AS (SELECT sum(n) AS n, sum(sqrt(n::DOUBLE)) AS w FROM c),
        r AS (SELECT c.source, round(sqrt(c.n::DOUBLE) / t.w * t.n::DOUBLE / c.n, 9) AS mix_rate FROM c, t),
        cdf AS (
            SELECT mix_rate, 0 AS k, exp(-mix_rate) AS p, exp(-mix_rate) AS cdf FROM (SELECT DISTINCT mix_rate FROM r)
            UNION ALL
            SELECT mix_rate, k + 1, p * mix_rate / (k + 1), cdf + p * mix_rate / (k + 1) FROM cdf
            WHERE k + 1 <= ceil(mix_rate + 12 * sqrt(mix_rate) + 20)
        ),
        d AS (
            SELECT documents.*, mix_rate,
                   ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
            FROM documents JOIN r ON documents.source IS NOT DISTINCT FROM r.source
        ),
        k AS (
            SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.mix_rate = d.mix_rate AND cdf.cdf <= d.u) AS mix_n FROM d
        ),
        m AS (SELECT * EXCLUDE (u, mix_n), unnest(range(1, mix_n + 1))::INTEGER AS mix_copy FROM k)
        SELECT doc_id, text, lang, source, n_chars, mix_rate, mix_copy,
               ('0x' || substr(md5('mix-order:' || doc_id || ':' || mix_copy), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS mix_key
        FROM m
    """,
    "op10_near_dedup": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)
    """,
    "op11_merkle": _manifest_sql(),
    "op12_repeats": _REPEATS_SQL,
    "op13_spelling": _spelling_sql(),
}
