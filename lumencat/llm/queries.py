"""The registered queries of the training-data operators: thin digests of their outputs."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, conversation_repair, html_extract, jaccard, language_id, lexical, packing, quality_classifier, quality_rules, simhash, topk, url_filters
from .common import checkpointed, table

#: The public tokenizer's file; the driver and the workers have it at the same place, which the environment may name.
WORD_BPE = os.environ.get("LUMENCAT_WORD_BPE") or str(public_tokenizers.path("word_bpe_49k.json"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    weights = html_extract.learn_weights(pages)
    found = pages.select("page_id", "url", html_extract.main_text(F.col("html"), weights).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality_rules.with_stats(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "qr_stats", "qr_base_failed")
    stats = checkpointed(stats)
    found = quality_rules.judged(stats, quality_rules.thresholds(quality_rules.sketch(stats)))
    measured = [F.col("qr_stats")[c].alias(c) for c in quality_rules.STATS[:5]]
    return found.select("doc_id", *measured, F.col("qr_base_failed").alias("base_failed"), F.col("qr_kept").alias("kept"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = quality_classifier.remainder(F.col("doc_id"), 5)
    model = quality_classifier.fit(docs, labels, rest != 0)
    found = quality_classifier.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = quality_classifier.remainder(F.col("doc_id"), 4)
    found = language_id.identified(docs, rest != 2)
    held = F.coalesce(quality_classifier.remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(tricky, "conv_id bigint, turn bigint, role string, text string"))
    done = chat_format.format_turns(chat_format.canonical_turns(rows))
    turns, loss = chat_format.read_turns(F.col("formatted")), chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = done.withColumn("turns", turns).withColumn("loss", loss)
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.voronoi_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_plans(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash": op2_simhash,
    "op3_html_extract": op3_html_extract,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_language_id": op6_language_id,
    "op7_chat_format": op7_chat_format,
    "op8_packing": op8_packing,
    "op9_bpe": op9_bpe,
    "op10_topk": op10_topk,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_jaccard_join": op13_jaccard_join,
}


def _quality_rules_sql() -> str:
    """The base statistics, the sketches as counts of geometric buckets, quartiles, gaps and pooling in SQL."""
    q = quality_rules
    rate = lambda e: f"CASE WHEN {e.split(' / ')[1]} > 0 THEN {e.split(' / ')[0]}::double / {e.split(' / ')[1]} ELSE 0 END"
    values = {m: rate(e) for m, (e, _, _) in q.MEASURES.items()} | {n: f"{n}::double" for n in q.LENGTHS}
    cells = " UNION ALL ".join(f"SELECT rid, lang, source, failed, '{m}' AS measure, {x} AS x FROM s" for m, x in values.items())
    sides = ", ".join(f"('{m}', '{side}', {f"'{n}'" if n else 'NULL'})" for m, (_, side, n) in q.MEASURES.items())

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        own, every = f"PARTITION BY {by}measure", f"PARTITION BY {keys}" if keys else ""
        typical = "CASE measured_in " + " ".join(f"WHEN '{n}' THEN min(value) FILTER (WHERE measure = '{n}' AND until >= 0.5 * total) OVER ({every})" for n in q.LENGTHS) + " END"
        return f"""
{name}0 AS (SELECT {by}measure, bucket, sum(n) AS n FROM k GROUP BY ALL),
{name}1 AS (SELECT *, sum(n) OVER ({own} ORDER BY bucket) AS until, sum(n) OVER ({own}) AS total, CASE WHEN bucket = {q.NOTHING} THEN 0 ELSE pow({q.GAMMA}::double, bucket) * 2 / (1 + {q.GAMMA}::double) END AS value FROM {name}0),
{name}2 AS (SELECT {name}1.*, side, {typical} AS length FROM {name}1 LEFT JOIN sides USING (measure)),
{name}3 AS (SELECT *, CASE WHEN length IS NOT NULL THEN ln(1 + value * length) ELSE ln(value) END AS z FROM {name}2 WHERE side IS NOT NULL),
{name}4 AS (SELECT *, lead(z) OVER ({own} ORDER BY bucket) AS following FROM {name}3),
{name}5 AS (SELECT {by}measure, any_value(side) AS side, any_value(length) AS length, max(total) AS size, min(z) FILTER (WHERE until >= 0.25 * total) AS z1, min(z) FILTER (WHERE until >= 0.75 * total) AS z3,
  min((z + following) / 2) FILTER (WHERE until >= 0.75 * total AND following - z >= ln({q.GAP}::double)) AS gap, min(z) AS least, max(z) AS most FROM {name}4 GROUP BY {by}measure),
{name}6 AS (SELECT *, CASE side WHEN 'high' THEN CASE WHEN z3 > z1 THEN z3 + {q.FENCE} * (z3 - z1) ELSE coalesce(gap, most + ln({q.GAP}::double)) END
  ELSE CASE WHEN z3 > z1 THEN z1 - {q.FENCE} * (z3 - z1) ELSE least - ln({q.GAP}::double) END END AS cut FROM {name}5),
{name} AS (SELECT {by}measure, size, CASE WHEN length IS NULL THEN cut ELSE ln((exp(cut) - 1) / length) END AS cut FROM {name}6)"""

    return f"""
WITH sides(measure, side, measured_in) AS (VALUES {sides}),
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c > 1) GROUP BY rid),
s0 AS (SELECT w.*, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(r.n, 0)::bigint AS n_repeat_words, len(ls) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals, len(regexp_extract_all(t, '!')) AS n_shouts
  FROM w LEFT JOIN r USING (rid)),
s AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM s0),
x AS ({cells}),
k AS (SELECT lang, source, measure, CASE WHEN x <= 1e-6 THEN {q.NOTHING} ELSE ceil(ln(x) / ln({q.GAMMA}::double))::bigint END AS bucket, count(*) AS n FROM x WHERE NOT failed GROUP BY ALL),
{level("f", "lang, source")}, {level("m", "lang")}, {level("c", "")},
u AS (SELECT f.lang, f.source, measure, exp((f.size * f.cut + {q.POOLED} * (m.size * m.cut + {q.POOLED} * c.cut) / (m.size + {q.POOLED})) / (f.size + {q.POOLED})) AS cut FROM f JOIN c USING (measure) JOIN m USING (measure) WHERE m.lang IS NOT DISTINCT FROM f.lang),
v AS (SELECT rid, bool_and(CASE side WHEN 'high' THEN x <= cut ELSE x >= cut END) AS good FROM x JOIN u USING (measure) JOIN sides USING (measure) WHERE x.lang IS NOT DISTINCT FROM u.lang AND x.source IS NOT DISTINCT FROM u.source GROUP BY rid)
SELECT doc_id, n_words::bigint AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed, NOT failed AND coalesce(good, false) AS kept FROM s LEFT JOIN v USING (rid)"""


def _conversation_repair_sql() -> str:
    """The dynamic program row by row in a recursive query: cost, letters and text of the best repair that ends in each role."""

    def plus(path: str, cost: str, letter: str, row: str) -> str:
        line = f" || CASE WHEN {path}.t = '' THEN '' ELSE chr(10) END || {row}" if row else ""
        return f"CASE WHEN {path} IS NOT NULL THEN {{'c': {path}.c + {cost}, 'e': {path}.e || '{letter}', 't': {path}.t{line}}} END"

    def best(*paths: str) -> str:
        return f"list_sort(list_filter([{', '.join(paths)}], lambda x: x IS NOT NULL))[1]"

    def when(test: str, path: str) -> str:
        return f"CASE WHEN {test} THEN {path} END"

    free, stay = "NOT n.blank AND NOT n.dup", "(CASE WHEN n.short THEN 5 ELSE 0 END)"
    kept, user, assistant = ("n.role || ':' || n.text", "'user:' || n.text", "'assistant:' || n.text")
    before_user = ("p.n", "p.s", "p.a")
    step = {
        "n": best(plus("p.n", "2", "D", "")),
        "s": best(plus("p.s", "2", "D", ""), when(f"{free} AND n.initial = 's'", plus("p.n", stay, "K", kept))),
        "u": best(
            plus("p.u", "2", "D", ""),
            *[when(free, plus(x, f"1 + {stay}", "R", user)) for x in before_user],
            *[when(f"{free} AND n.initial = 'u'", plus(x, stay, "K", kept)) for x in before_user],
        ),
        "a": best(plus("p.a", "2", "D", ""), when(free, plus("p.u", f"1 + {stay}", "R", assistant)), when(f"{free} AND n.initial = 'a'", plus("p.u", stay, "K", kept))),
    }
    with_user = best("u", *[plus(x, "5", "I", "'user:'") for x in ("n", "s", "a")])
    with_assistant = best("a", plus("u", "5", "I", "'assistant:'"))
    steps = ", ".join(f"{sql} AS {x}" for x, sql in step.items())
    white = r"[^\x20\x09-\x0D]"
    path = "STRUCT(c BIGINT, e VARCHAR, t VARCHAR)"
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [unicode(x)::ubigint for x in regexp_extract_all(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), '.')] AS bytes FROM conversations),
h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::ubigint, bytes), lambda c, b: list_reduce(list_prepend(xor(c, b), [x::ubigint for x in range(8)]),
    lambda r, i: xor(r >> 1, (r & 1::ubigint) * 3988292384::ubigint))), 4294967295::ubigint) % 20 AS deal FROM k),
d0 AS (SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role, CASE deal WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, deal FROM h WHERE deal <> 0),
d AS (SELECT *, 0 AS copy FROM d0 UNION ALL SELECT *, 1 FROM d0 WHERE deal = 3),
n AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS dup, NOT regexp_matches(text, '{white}') AS blank,
  coalesce(regexp_extract(text, '({white})[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?'), true) AS short FROM d),
p AS (
  SELECT DISTINCT conv_id, 0::bigint AS i, {{'c': 0::bigint, 'e': '', 't': ''}}::{path} AS n, NULL::{path} AS s, {{'c': 5::bigint, 'e': 'I', 't': 'user:'}}::{path} AS u,
    {{'c': 10::bigint, 'e': 'II', 't': 'user:' || chr(10) || 'assistant:'}}::{path} AS a FROM n
  UNION ALL
  SELECT conv_id, i, n, s, u, {with_assistant} AS a FROM (SELECT conv_id, i, n, s, {with_user} AS u, a FROM (
    SELECT n.conv_id, n.i, {steps} FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.i = p.i + 1))),
g AS (SELECT conv_id, max(i) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(dup AND NOT blank) AS dup,
  count_if(short AND NOT blank AND NOT dup) AS short, count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n) GROUP BY conv_id),
f AS (SELECT g.*, {best("p.n", "p.a")} AS best FROM g JOIN p ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND p.i = g.size),
o AS (SELECT DISTINCT conv_id AS id FROM conversations)
SELECT o.id AS conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(dup, 0)::bigint AS duplicate, coalesce(short, 0)::bigint AS truncated,
  coalesce(illegal, 0)::bigint AS illegal, coalesce(best.c, 0)::bigint AS cost, coalesce(best.e, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM o LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM o.id"""


#: The terms of a text for ranked search.
_TERMS = r"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_ESCAPED = r"length(regexp_replace({c}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))"

ORACLES: dict[str, str] = {
    "op4_quality_rules": _quality_rules_sql(),
    "op7_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(length('<s>[INST][/INST]</s>') + {_ESCAPED.format(c="role")} + {_ESCAPED.format(c="text")})::bigint AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::bigint AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op10_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_conversation_repair": _conversation_repair_sql(),
    "op12_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format(t="text")} AS ts FROM documents),
c AS (SELECT count(*) AS docs, sum(len(ts))::bigint AS terms FROM d WHERE len(ts) > 0),
tf AS (SELECT rid, doc_id, size, t, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS size, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), c),
q AS (SELECT item_id, t, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS.format(t="text")}) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, rid, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * docs) // terms))))::bigint AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::int AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
    "op13_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS s FROM d),
e AS (SELECT min(rid) AS node, list_sort(s) AS s, min(doc_id) AS least FROM g WHERE len(s) > 0 GROUP BY list_sort(s)),
p AS (SELECT node, len(s) AS size, unnest(s) AS x FROM e),
l AS (SELECT a.node AS a, b.node AS b FROM p a JOIN p b ON a.x = b.x AND a.node <> b.node AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
  GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
r AS (SELECT node AS a, node AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT r.a AS node, min(e.least) AS component_id FROM r JOIN e ON e.node = r.b GROUP BY r.a),
k AS (SELECT g.rid, c.component_id FROM g JOIN e ON list_sort(g.s) = e.s JOIN c ON c.node = e.node WHERE len(g.s) > 0)
SELECT doc_id, len(s)::bigint AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id FROM g LEFT JOIN k USING (rid)""",
}
