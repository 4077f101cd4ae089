"""SQL twins of the operators whose rounds or pairs need more than a short statement."""

from __future__ import annotations

from pointflow.llm import value_codebooks as vc


def vector_codes() -> str:
    """Integer k-means on vector parts, one pair of statements per round."""
    start = f"""
        WITH good AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vc.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), ranked AS (
            SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM good
        ), parts AS MATERIALIZED (
            SELECT r, vec_id, label, p, v[p * (len(v) // {vc.PARTS}) + 1 : (p + 1) * (len(v) // {vc.PARTS})] AS part
            FROM ranked, range({vc.PARTS}) AS t(p)
        ), book0 AS (
            SELECT p, r AS e, part AS c FROM parts WHERE r < {vc.ENTRIES}
        )"""
    assign = """
        , near{i} AS MATERIALIZED (
            SELECT r, p, any_value(vec_id) AS vec_id, any_value(label) AS label, any_value(part) AS part,
                   arg_min(e, d * 256 + e) AS e, min(d) AS d
            FROM (
                SELECT parts.*, e, list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
                FROM parts JOIN book{i} USING (p)
            )
            GROUP BY r, p
        )"""
    update = """
        , mean{i} AS (
            SELECT p, e, list(m ORDER BY j) AS c
            FROM (
                SELECT p, e, j, CAST(floor(CAST(sum(part[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m
                FROM (SELECT p, e, part, unnest(range(1, len(part) + 1)) AS j FROM near{i})
                GROUP BY p, e, j
            )
            GROUP BY p, e
        ), book{k} AS MATERIALIZED (
            SELECT p, e, coalesce(mean{i}.c, book{i}.c) AS c FROM book{i} LEFT JOIN mean{i} USING (p, e)
        )"""
    rounds = "".join((assign + update).format(i=i, k=i + 1) for i in range(vc.ROUNDS)) + assign.format(i=vc.ROUNDS)
    return f"""{start}{rounds}
        , coded AS (
            SELECT any_value(vec_id) AS vec_id, any_value(label) AS label,
                   string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM near{vc.ROUNDS} GROUP BY r
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{vc.ROUNDS}) AS codebooks_sha256
        FROM coded
    """


SOURCE_AUDIT = r"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), kept AS MATERIALIZED (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d)
        GROUP BY lang, term HAVING count(*) >= 10
    ), vocab AS (
        SELECT lang, count(*) AS v FROM kept GROUP BY lang
    ), grp AS (
        SELECT DISTINCT lang, source FROM d
    ), tokens AS (
        SELECT lang, source, term, count(*) AS n
        FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN kept USING (lang, term)
        GROUP BY lang, source, term
    ), dense AS (
        SELECT lang, source, term, coalesce(n, 0) AS n
        FROM grp JOIN kept USING (lang) LEFT JOIN tokens USING (lang, source, term)
    ), p AS MATERIALIZED (
        SELECT lang, source, term, n,
               1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
        FROM dense JOIN vocab USING (lang)
    ), q AS MATERIALIZED (
        SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
        FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term) JOIN vocab USING (lang)
    ), apart AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    ), terms AS (
        SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
        FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
    )
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, CAST(value AS BIGINT),
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM terms QUALIFY rank <= 10
"""
