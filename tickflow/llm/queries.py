"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (boosted_rules, bpe_counts, decontam, filter_audit, hyperlang, manifest, mixing, neardup, preferences, secret_scan, weak_labels,
               wrapper, zip_archives)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_mix_pivotal")
def op6(spark, sf_dir):
    return mixing.plan_of(table(spark, sf_dir, "documents"))


# matches start after the pieces between them and the matches before; owners are counted over all values
_OP7_KINDS = " UNION ALL ".join(
    f"SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(text, '{pattern}', 0) AS w, "
    f"regexp_extract_all(text, '{pattern}', {group}) AS v, string_split_regex(text, '{pattern}') AS g, {least} AS least FROM d"
    for rank, (kind, pattern, group, least) in enumerate((
        ("assign", secret_scan.ASSIGN.replace("'", "''"), 2, secret_scan.ASSIGN_CHARS), ("access", secret_scan.ACCESS, 0, 0),
        ("hex", secret_scan.HEX, 0, 0), ("opaque", secret_scan.OPAQUE, 0, 0))))
OP7_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
k AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM ({_OP7_KINDS}) WHERE len(w) > 0),
m AS (SELECT doc_id, source, kind, rank, v[i] AS val, length(w[i]) AS n, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
             + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS a FROM k WHERE length(v[i]) >= least),
e AS (SELECT *, regexp_replace(val, '{secret_scan.JOINTS}', '', 'g') AS core FROM m),
c AS (SELECT *, a + n AS b FROM e WHERE rank < 3 OR (
          regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]')
          AND NOT regexp_matches(val, '{secret_scan.UUID}')
          AND len(list_distinct(string_split(val, ''))) >= {secret_scan.LEAST_DIFFERENT}
          AND 5 * length(regexp_replace(core, '{secret_scan.NAME_PART}', '', 'g')) >= 2 * length(core)
          AND 10 * (len(regexp_extract_all(core, '{secret_scan.CASE_RUN}')) - 1) >= 3 * length(core))),
o AS (SELECT val, count(DISTINCT coalesce('=' || source, '')) AS owners FROM c GROUP BY val),
s AS (SELECT c.*, owners FROM c JOIN o USING (val) WHERE rank < 3 OR (owners <= {secret_scan.MAX_OWNERS} AND NOT EXISTS (
          SELECT 1 FROM c AS x WHERE x.doc_id = c.doc_id AND x.rank < 3 AND x.a < c.b AND c.a < x.b)))
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || a::INT || ':' || b::INT, ',' ORDER BY a, rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || a::INT || ':' || b::INT, ',' ORDER BY a, rank) FILTER (rank IS NOT NULL), '') AS spans,
       count(*) FILTER (owners <= {secret_scan.MAX_OWNERS}) AS n_live
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op7_secret_ownership", OP7_SQL)
def op7(spark, sf_dir):
    return secret_scan.spans_of(table(spark, sf_dir, "documents"))


# words of the items and documents, windows of the items, and where they stand in the documents
OP4_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
iw AS (SELECT item_id, regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, letters),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents, letters),
grams AS (
    SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT doc_id, item_id, p, k FROM grams JOIN windows USING (k, g)),
words_hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM hits) GROUP BY doc_id),
items_hit AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
              FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""


@query("op4_suffix_automaton", OP4_SQL)
def op4(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# all pairs that share a shingle, then the least id reachable along links
OP5_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, links.v FROM reach JOIN links ON reach.r = links.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(r) AS component_id FROM reach GROUP BY d) c ON c.d = d.doc_id
"""


@query("op5_minhash_hamming", OP5_SQL)
def op5(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_weak_label_quality")
def op3(spark, sf_dir):
    scored = weak_labels.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.withColumnRenamed("accepted", "kept")


@query("op10_bpe_heap_counts")
def op10(spark, sf_dir):
    import public_tokenizers
    return bpe_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_boosted_rules")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return boosted_rules.judge(docs, boosted_rules.fit(docs, table(spark, sf_dir, "labels")))


# base32 of the digest: 40 groups of five bits of 160, as letters A-Z and digits 2-7
OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x FROM p),
bits AS (SELECT page_id, n, x, array_to_string(list_transform(string_split(x, ''), lambda c: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', c) - 1)::INT + 1, 4)), '') AS b FROM d),
g AS (SELECT x, max(page_id) AS first FROM d GROUP BY x)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           16 * substr(b, (5 * i + 1)::INT, 1)::INT + 8 * substr(b, (5 * i + 2)::INT, 1)::INT + 4 * substr(b, (5 * i + 3)::INT, 1)::INT
           + 2 * substr(b, (5 * i + 4)::INT, 1)::INT + substr(b, (5 * i + 5)::INT, 1)::INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits JOIN g USING (x)
"""


@query("op9_zip_warc", OP9_SQL)
def op9(spark, sf_dir):
    return zip_archives.round_trip(spark, table(spark, sf_dir, "pages"))


# turns numbered from 1, pairs of conversations as rows, first place where they differ, and what is rendered around it
OP8_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, role, text
           FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, min(i) FILTER (role = 'user') AS u, max(i) FILTER (role = 'assistant') AS last,
             coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS chars, (max_by(role, i) = 'assistant')::INT AS ends FROM t GROUP BY conv_id),
o AS (SELECT conv_id, ends, chars, list(struct_pack(r := role, x := text) ORDER BY i) AS opening
      FROM t JOIN c USING (conv_id) WHERE i <= u GROUP BY ALL),
r AS (SELECT *, first_value(conv_id) OVER (PARTITION BY opening ORDER BY ends DESC, chars DESC, conv_id) AS best FROM o),
sides AS (
    SELECT conv_id AS p, conv_id AS chosen_id, NULL::BIGINT AS rejected_id, 'cut' AS kind FROM c WHERE last IS NOT NULL
    UNION ALL SELECT -1 - conv_id, best, conv_id, 'opening' FROM r WHERE best <> conv_id),
a AS (SELECT p, i, role, text FROM sides JOIN t ON t.conv_id = chosen_id),
b AS (SELECT p, i, role, CASE WHEN kind = 'cut' AND i = last THEN substr(text, 1, (length(text) // 2)::INT) ELSE text END AS text
      FROM sides JOIN t ON t.conv_id = coalesce(rejected_id, chosen_id) JOIN c ON c.conv_id = t.conv_id),
d AS (SELECT p, min(i) AS pos FROM (SELECT coalesce(a.p, b.p) AS p, coalesce(a.i, b.i) AS i FROM a FULL JOIN b ON a.p = b.p AND a.i = b.i
      WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text) GROUP BY p),
w AS (SELECT side, p, i, pos, role, '<|' || role || '|>' || chr(10) AS head, text, '<|end|>' || chr(10) AS tail
      FROM (SELECT 'a' AS side, * FROM a UNION ALL SELECT 'b', * FROM b) JOIN d USING (p)),
s AS (SELECT *, coalesce(sum(length(head) + length(text) + length(tail)) OVER (PARTITION BY side, p, i < pos ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS b0
      FROM w),
g AS (SELECT p, side, coalesce(string_agg(head || text || tail, '' ORDER BY i) FILTER (i < pos), '') AS prompt,
             coalesce(string_agg(head || text || tail, '' ORDER BY i) FILTER (i >= pos), '') AS rest,
             coalesce(string_agg(b0 || '-' || (b0 + length(text) + length(tail)), ',' ORDER BY i) FILTER (i >= pos AND role = 'assistant'), '') AS mask
      FROM s GROUP BY p, side)
SELECT chosen_id, rejected_id, kind, (pos - 1)::INT AS n_prefix, coalesce(x.prompt, y.prompt) AS prompt, coalesce(x.rest, '') AS chosen,
       coalesce(y.rest, '') AS rejected, coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask
FROM sides JOIN d USING (p) LEFT JOIN (SELECT * FROM g WHERE side = 'a') x USING (p) LEFT JOIN (SELECT * FROM g WHERE side = 'b') y USING (p)
"""


@query("op8_preference_pairs", OP8_SQL)
def op8(spark, sf_dir):
    return preferences.format_preferences(table(spark, sf_dir, "conversations"))


@query("op2_wrapper_induction")
def op2(spark, sf_dir):
    return wrapper.extract(table(spark, sf_dir, "pages"))


@query("op11_hyperdimensional_language")
def op11(spark, sf_dir):
    return hyperlang.languages(table(spark, sf_dir, "documents"))


# a level per CTE: nodes, then runs of eight as lists; groups that are down to one node stay as they are
_LEVELS, _TOP_LEVELS = 12, 4


def _levels(name: str, first: str, levels: int) -> str:
    steps = [f"{name}0 AS ({first})"]
    for k in range(levels):
        steps.append(f"{name}r{k} AS (SELECT g, pos // 8 AS pos, any_value(n) AS n, list(h ORDER BY pos) AS hs FROM {name}{k} WHERE n > 1 GROUP BY g, pos // 8)")
        steps.append(f"{name}{k + 1} AS (SELECT g, pos, (n + 7) // 8 AS n, sha256(array_to_string(hs, '')) AS h FROM {name}r{k} UNION ALL "
                     f"SELECT g, pos, n, h FROM {name}{k} WHERE n = 1)")
    return ", ".join(steps)


def _climb(name: str, rows: str, g: str, place: str, levels: int) -> str:
    """Each level adds the siblings to ``proof`` and hashes them around ``h``."""
    steps, at = [], rows
    for k in range(levels):
        slot = f"({place} // {8 ** k}) % 8"
        left, right = f"array_to_string(r.hs[1:({slot})::INT], '')", f"array_to_string(r.hs[({slot} + 2)::INT:], '')"
        steps.append(f"{name}{k} AS (SELECT d.* EXCLUDE (h, proof), CASE WHEN r.hs IS NULL THEN d.h ELSE sha256({left} || d.h || {right}) END AS h, "
                     f"d.proof || coalesce({left} || {right}, '') AS proof FROM {at} d "
                     f"LEFT JOIN {name[0]}r{k} r ON r.g = {g} AND r.pos = {place} // {8 ** (k + 1)})")
        at = f"{name}{k}"
    return ", ".join(steps)


def _leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


# CRC-32 bit by bit over the digits of the id
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)), 4294967295::BIGINT)")
_LAST = f"c{_LEVELS - 1}"
OP12_SQL = f"""
WITH leaf AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('text')} AS leaf,
                     CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
              FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaf),
{_levels('c', 'SELECT g, pos, n, leaf AS h FROM placed', _LEVELS)},
tops AS (SELECT g AS lang_, h, row_number() OVER (ORDER BY g) - 1 AS top, count(*) OVER () AS n FROM c{_LEVELS}),
{_levels('t', "SELECT '' AS g, top AS pos, n, h FROM tops", _TOP_LEVELS)},
docs AS (SELECT doc_id, g, pos, leaf, top, tops.h AS subroot, coalesce(changed, leaf) AS h, '' AS proof FROM placed JOIN tops ON lang_ = g),
{_climb('cd', 'docs', 'd.g', 'd.pos', _LEVELS)}, {_climb('td', f'cd{_LEVELS - 1}', "''", 'd.top', _TOP_LEVELS)}
SELECT doc_id, leaf, subroot, (SELECT h FROM t{_TOP_LEVELS}) AS root, sha256(proof) AS proof_sha256, h AS folded_root,
       h = (SELECT h FROM t{_TOP_LEVELS}) AS verified FROM td{_TOP_LEVELS - 1}
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    return manifest.verify(table(spark, sf_dir, "documents"))


# which filters a document fails as bits, and each order's steps by the bits that went before
OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > least, false)::INT AS fails,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic FROM d),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(name, bit)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
m AS (SELECT DISTINCT bit, before FROM s),
g AS (SELECT p.part, m.bit, m.before, coalesce(sum(n) FILTER (fails & (m.bit | m.before) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (fails & m.bit > 0 AND fails & m.before = 0), 0) AS removed,
             coalesce(sum(n) FILTER (fails & m.bit > 0 AND fails & m.before > 0), 0) AS redundant, coalesce(sum(n) FILTER (fails = m.bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (fails & m.bit > 0 AND fails & m.before = 0), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (fails & m.bit > 0 AND fails & m.before = 0), 0) AS toxic_lost
      FROM (SELECT DISTINCT part FROM f) p, m JOIN c ON true WHERE c.part = p.part GROUP BY ALL),
h AS (SELECT part, s.bit, sum(removed) AS shapley FROM s JOIN g ON g.bit = s.bit AND g.before = s.before GROUP BY ALL)
SELECT g.part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley
FROM s JOIN g ON g.bit = s.bit AND g.before = s.before JOIN h ON h.part = g.part AND h.bit = s.bit
"""


@query("op13_filter_interactions", OP13_SQL)
def op13(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
