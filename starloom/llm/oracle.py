"""DuckDB statements of the queries of this folder that SQL can express."""

from __future__ import annotations

from starloom.llm import sharding, warc_revisit

#: Terms and parts of a text, as the queries' contracts give them.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LINES = r"[^\n]*\n|[^\n]+"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sharding() -> str:
    """The table is filled by a plain restatement of the rule (each shard in
    turn walks its whole permutation to the first free slot) and passed as one
    hexadecimal digit a slot; key digest, slot and lookup are SQL's own."""
    import hashlib
    slots, names = sharding.SLOTS, sharding.SHARDS

    def permutation(name):
        digest = hashlib.sha256(name.encode()).hexdigest()
        first, step = int(digest[:16], 16) % slots, int(digest[16:32], 16) % (slots - 1) + 1
        return ((first + j * step) % slots for j in range(slots))

    walk = {n: permutation(n) for n in names}
    free, digits = set(range(slots)), ["?"] * slots
    while free:
        for i, n in enumerate(names):
            if free:
                slot = next(x for x in walk[n] if x in free)
                free.remove(slot)
                digits[slot] = f"{i:x}"
    key = "coalesce(cast(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))"
    slot = f"cast(cast('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {slots} AS INTEGER)"
    return (f"SELECT doc_id, 'shard-' || lpad(cast(cast('0x' || substr('{''.join(digits)}', {slot} + 1, 1) AS INTEGER)"
            f" AS VARCHAR), 2, '0') AS shard FROM documents")


def _fill_in_middle() -> str:
    h = ", ".join(f"cast('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    run = lambda a, z: f"array_to_string(units[{a}:{z}], '')"
    return f"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{LINES}') AS units,
                  sha256('7:' || coalesce(cast(doc_id AS VARCHAR), '')) AS digest FROM documents),
     b AS (SELECT *, len(units) AS n, {h} FROM a),
     c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM b),
     d AS (SELECT *, {run("1", "x")} AS pre, {run("x + 1", "y")} AS mid, {run("y + 1", "n")} AS suf FROM c)
SELECT doc_id, cast(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN cast(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN cast(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM d"""


def _lexical_search() -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLDED}, '{TERMS}') AS ts FROM documents),
     s AS (SELECT cast(count(*) FILTER (WHERE len(ts) > 0) AS BIGINT) AS docs, cast(sum(len(ts)) AS BIGINT) AS length FROM d),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({FOLDED}, '{TERMS}')) AS term FROM benchmark),
     p AS (SELECT doc_id, n, term, cast(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, cast(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d)
           WHERE term IN (SELECT term FROM i) GROUP BY ALL),
     w AS (SELECT term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
     m AS (SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
           FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM m WHERE score > 0)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50"""


def _warc_revisit() -> str:
    """The as-of join by DuckDB's own operator; the derived URLs have no query."""
    step, late = warc_revisit.STEP, warc_revisit.LATE
    return f"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[^/]*//([^/]*/[^/?#]*)', 1) AS u, md5(coalesce(html, '')) AS tag,
                  coalesce(length(html), 0) AS size, CAST(page_id * {step} AS BIGINT) AS ts, CAST('0x' || substr(md5(coalesce(html, '')), 1, 8) AS BIGINT) AS late FROM pages),
     c AS (SELECT *, regexp_replace(lower(split_part(u, '/', 1)), '^www[.]|:(80|443)$', '')
                     || CASE WHEN split_part(u, '/', 2) <> '' THEN '/' || split_part(u, '/', 2) ELSE '' END AS canon FROM p),
     f AS (SELECT canon, ts, page_id * 2 AS response_id, tag AS held, size FROM c WHERE late % 10 <> 7),
     r AS (SELECT canon, ts + 1 + late % {late} AS ts, page_id * 2 + 1 AS record_id, tag FROM c)
SELECT r.record_id, r.canon AS url, r.ts, CASE WHEN f.response_id IS NULL THEN 'orphan' WHEN f.held <> r.tag THEN 'mismatch' ELSE 'resolved' END AS verdict,
       f.response_id, CASE WHEN f.held = r.tag THEN '{{"content-length":"' || f.size || '","content-type":"text/html","date":"' || r.ts
                           || '","etag":"W/\\"' || r.tag || '\\""}}' END AS headers
FROM r ASOF LEFT JOIN f ON r.canon = f.canon AND r.ts > f.ts"""


def oracle_sql() -> dict[str, str]:
    return {"op4_sharding": _sharding(), "op9_warc_revisit": _warc_revisit(),
            "op11_fill_in_middle": _fill_in_middle(), "op13_lexical_search": _lexical_search()}
