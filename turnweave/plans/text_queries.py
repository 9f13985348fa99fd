"""Queries over text, tags, ids and JSON, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_repair as J
from ..functions import text as X
from .inputs import LINES, POOL, SCRIPTS, TURNS, lines, scripts, table, turns

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@query(rf"WITH {SCRIPTS}, x AS (SELECT conv_id, unnest(string_split(script, chr(10))) AS line, generate_subscripts(string_split(script, chr(10)), 1) - 1 AS pos FROM scripts) "
       r"SELECT conv_id, CAST(pos AS INTEGER) AS pos, trim(regexp_extract(line, '^([^:]*):', 1), ' ') AS role, trim(regexp_extract(line, '^[^:]*:(.*)$', 1), ' ') AS content FROM x WHERE line LIKE '%:%'")
def script_parse(spark: SparkSession, d: str) -> DataFrame:
    """Script lines split at the first colon; lines without one are dropped."""
    s = scripts(spark, d).select("conv_id", F.posexplode(F.split("script", "\n")).alias("pos", "line")).where(F.col("line").contains(":"))
    p = X.parse_line(F.col("line"))
    return s.select("conv_id", "pos", p["role"].alias("role"), p["content"].alias("content"))


@query(rf"WITH {LINES} SELECT conv_id, turn_index, role LIKE '%User' AS is_user, role LIKE '[pause]%' AS is_pause, role LIKE '[overlap]%' AS is_overlap FROM lines")
def speaker_roles(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("role")
    return lines(spark, d).select("conv_id", "turn_index", X.is_user(r).alias("is_user"), X.is_pause(r).alias("is_pause"), X.is_overlap(r).alias("is_overlap"))


@query(rf"WITH {LINES} SELECT conv_id, turn_index, lower(role) IN ('user', '[overlap] user', '[pause] user') AS is_user FROM lines")
def speaker_roles_strict(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).select("conv_id", "turn_index", X.is_user_strict(F.col("role")).alias("is_user"))


@query(rf"WITH {LINES} SELECT conv_id, turn_index, nullif(lower(trim(regexp_extract(content, '(?i)^\s*\(\s*emotion\s*:\s*([^)]+)\)\s*', 1), ' ')), '') AS emotion, "
       r"trim(regexp_replace(content, '(?i)^\s*\(\s*emotion\s*:\s*[^)]+\)\s*', ''), ' ') AS rest FROM lines")
def leading_emotion(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    return lines(spark, d).select("conv_id", "turn_index", X.leading_emotion(c).alias("emotion"), X.strip_leading_emotion(c).alias("rest"))


_IN_POOL = "(" + ", ".join(f"'{p}'" for p in POOL) + ")"


@query(rf"WITH {LINES}, s AS (SELECT conv_id, turn_index, content, regexp_replace(trim(content, ' '), '^\*+\s*', '') AS s FROM lines), "
       r"p AS (SELECT *, trim(regexp_extract(s, '^/([^/]+)/', 1), ' ') AS i1, regexp_extract(s, '(?s)^/[^/]+/\s*(.*)', 1) AS r1, trim(regexp_extract(s, '^\(([^)]*)\)', 1), ' ') AS i2, "
       r"regexp_replace(trim(regexp_extract(s, '(?s)^\([^)]*\)(.*)', 1), ' '), '^\*+\s*', '') AS r2, regexp_extract(s, '(?i)^emotion\s*[:=]\s*([A-Za-z_\-]+)', 1) AS e3, "
       r"regexp_extract(s, '(?is)^emotion\s*[:=]\s*[A-Za-z_\-]+\s*(.*)', 1) AS r3, trim(regexp_extract(s, '(?s)^(.*?)\s*[(\[/]([^)\]/]+)[)\]/]\s*$', 2), ' ') AS i4, "
       r"regexp_extract(s, '(?s)^(.*?)\s*[(\[/]([^)\]/]+)[)\]/]\s*$', 1) AS r4 FROM s), "
       r"e AS (SELECT *, coalesce(nullif(regexp_extract(i1, '(?i)^emotion\s*[:=]\s*([A-Za-z_\-]+)\s*$', 1), ''), i1) AS e1, coalesce(nullif(regexp_extract(i2, '(?i)^emotion\s*[:=]\s*([A-Za-z_\-]+)\s*$', 1), ''), i2) AS e2, "
       r"coalesce(nullif(regexp_extract(i4, '(?i)^emotion\s*[:=]\s*([A-Za-z_\-]+)\s*$', 1), ''), i4) AS e4 FROM p) "
       rf"SELECT conv_id, turn_index, CASE WHEN e1 IN {_IN_POOL} THEN rtrim('(emotion:' || e1 || ') ' || trim(r1, ' '), ' ') WHEN e2 IN {_IN_POOL} THEN rtrim('(emotion:' || e2 || ') ' || trim(r2, ' '), ' ') "
       rf"WHEN e3 IN {_IN_POOL} THEN rtrim('(emotion:' || e3 || ') ' || trim(r3, ' '), ' ') WHEN e4 IN {_IN_POOL} THEN rtrim('(emotion:' || e4 || ') ' || trim(r4, ' '), ' ') ELSE content END AS tagged FROM e")
def normalize_emotion(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).select("conv_id", "turn_index", X.normalize_emotion(F.col("content"), POOL).alias("tagged"))


@query(rf"WITH {LINES} SELECT conv_id, string_agg(CASE WHEN c = '' THEN role || ':' ELSE role || ': ' || c END, chr(10) ORDER BY turn_index) AS stripped FROM "
       r"(SELECT *, trim(regexp_replace(trim(content, ' '), '(?i)^\s*\(\s*emotion\s*:\s*[^)]+\)\s*', ''), ' ') AS c FROM lines) GROUP BY conv_id")
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return scripts(spark, d).select("conv_id", X.strip_emotion_tags(F.col("script")).alias("stripped"))


@query()
def sanitize_tts(spark: SparkSession, d: str) -> DataFrame:
    """All lines; word boundaries differ between engines, so that there is no SQL."""
    return lines(spark, d).select("conv_id", "turn_index", X.sanitize_tts(F.col("content")).alias("clean"))


@query(rf"WITH {LINES} SELECT conv_id, turn_index, '[overlap] ' || speaker || ': ' || text || chr(10) || 'tail [pause]' AS joined FROM lines")
def header_join(spark: SparkSession, d: str) -> DataFrame:
    broken = F.concat(F.lit("[overlap]\n  "), "speaker", F.lit(": "), "text", F.lit("\ntail [pause]"))
    return lines(spark, d).select("conv_id", "turn_index", X.join_headers(broken).alias("joined"))


@query(rf"WITH {LINES}, b AS (SELECT conv_id, turn_index, text, speaker, h FROM lines), p AS ("
       r"SELECT conv_id, turn_index, 1 AS pos, speaker || ': ' || text AS line FROM b UNION ALL SELECT conv_id, turn_index, 2, '[pause] User: [pause]' FROM b WHERE h % 3 = 0 "
       r"UNION ALL SELECT conv_id, turn_index, 3, 'User: more' FROM b WHERE h % 3 = 0) SELECT conv_id, string_agg(line, '|' ORDER BY turn_index, pos) AS split FROM p GROUP BY conv_id")
def pause_split(spark: SparkSession, d: str) -> DataFrame:
    mixed = F.concat("speaker", F.lit(": "), "text", F.when(F.col("h") % 3 == 0, F.lit(" [PAUSE]  User:[pause] User: more")).otherwise(F.lit("  ")))
    rows = lines(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn_index", mixed.alias("x")))).alias("a"))
    return rows.select("conv_id", F.array_join(X.split_pauses(F.transform("a", lambda s: s["x"])), "|").alias("split"))


@query(rf"WITH {LINES}, w AS (SELECT conv_id, turn_index, role || ': ' || content AS line, lead(role || ': ' || content) OVER v AS nxt, lag(role || ': ' || content) OVER v AS prv FROM lines "
       r"WINDOW v AS (PARTITION BY conv_id ORDER BY turn_index)), m AS (SELECT conv_id, turn_index, CASE WHEN starts_with(line, 'User:') AND starts_with(coalesce(nxt, ''), '[overlap] User:') "
       r"THEN rtrim(line, ' ') || ' ' || ltrim(substr(nxt, 16), ' ') ELSE line END AS line FROM w WHERE NOT (starts_with(line, '[overlap] User:') AND starts_with(coalesce(prv, ''), 'User:'))) "
       r"SELECT conv_id, string_agg(line, chr(10) ORDER BY turn_index) AS merged FROM m GROUP BY conv_id")
def merge_user_overlap(spark: SparkSession, d: str) -> DataFrame:
    return scripts(spark, d).select("conv_id", F.array_join(X.merge_overlaps(F.col("lines")), "\n").alias("merged"))


_STEMS = r"SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN source || '_scenario' || doc_id WHEN 1 THEN source || '_scenario' || doc_id || '_' || (doc_id % 3) WHEN 2 THEN 'scenario' || lpad(CAST(doc_id AS VARCHAR), 6, '0') WHEN 3 THEN 'scenario' || doc_id || '_1' ELSE 'notes ' || doc_id END AS stem FROM documents"


def _stems(spark: SparkSession, d: str) -> DataFrame:
    n, s = F.col("doc_id"), F.col("doc_id").cast("string")
    stem = (
        F.when(n % 5 == 0, F.concat("source", F.lit("_scenario"), s))
        .when(n % 5 == 1, F.concat("source", F.lit("_scenario"), s, F.lit("_"), (n % 3).cast("string")))
        .when(n % 5 == 2, F.concat(F.lit("scenario"), F.lpad(s, 6, "0")))
        .when(n % 5 == 3, F.concat(F.lit("scenario"), s, F.lit("_1")))
        .otherwise(F.concat(F.lit("notes "), s))
    )
    return table(spark, d, "documents").select("doc_id", stem.alias("stem"))


@query(rf"WITH s AS ({_STEMS}) SELECT doc_id, nullif(regexp_extract(stem, '^(?:(.+)_)?(scenario(\d+))(?:_(\d+))?$', 1), '') AS prefix, 'scenario' || TRY_CAST(nullif(regexp_extract(stem, '^(?:(.+)_)?(scenario(\d+))(?:_(\d+))?$', 3), '') AS BIGINT) AS scenario_id, "
       r"CAST(nullif(regexp_extract(stem, '^(?:(.+)_)?(scenario(\d+))(?:_(\d+))?$', 3), '') AS BIGINT)::VARCHAR AS scenario_index, nullif(regexp_extract(stem, '^(?:(.+)_)?(scenario(\d+))(?:_(\d+))?$', 4), '') AS dialogue_index FROM s")
def stem_parse(spark: SparkSession, d: str) -> DataFrame:
    p = X.parse_stem(F.col("stem"))
    return _stems(spark, d).select("doc_id", *(c.cast("string").alias(n) for n, c in p.items()))


@query(rf"WITH s AS ({_STEMS}), x AS (SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN CAST(doc_id AS VARCHAR) ELSE regexp_replace(stem, '_\d+$', '') END AS raw FROM s) "
       r"SELECT doc_id, coalesce('scenario' || CAST(nullif(regexp_extract(raw, '(?:^|_)scenario(\d+)$', 1), '') AS BIGINT), 'scenario' || CAST(nullif(regexp_extract(raw, '^(\d+)$', 1), '') AS BIGINT), raw) AS scenario_id FROM x")
def canonical_id(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 5 == 4, F.col("doc_id").cast("string")).otherwise(F.regexp_replace("stem", r"_\d+$", ""))
    return _stems(spark, d).select("doc_id", X.canonical_scenario_id(raw).alias("scenario_id"))


@query(r"SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_name || ' / ' || p_type || '!', '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'unknown') AS slug FROM part")
def topic_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.topic_slug(F.concat("p_name", F.lit(" / "), "p_type", F.lit("!"))).alias("slug"))


@query(r"SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'unknown' ELSE c_name END AS label FROM customer")
def topic_label(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    topic = F.when(k == 0, F.concat("c_name", F.lit("（ "), "c_mktsegment", F.lit("）"))).when(k == 1, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" ")))
    return table(spark, d, "customer").select("c_custkey", X.topic_label(topic).alias("label"))


@query(rf"WITH {TURNS} SELECT conv_id, turn_index, CAST(length(text) % 101 AS BIGINT) AS score FROM turns WHERE h % 4 <> 0")
def score_extract(spark: SparkSession, d: str) -> DataFrame:
    """Scores from judge responses; responses without one are dropped."""
    reply = F.when(F.col("h") % 4 != 0, F.concat(F.lit("The reply. Score:  "), (F.length("text") % 101).cast("string"), F.lit(" of 100"))).otherwise(F.lit("no score given"))
    return turns(spark, d).select("conv_id", "turn_index", X.score_of(reply).alias("score")).where("score is not null")


@query(r"SELECT doc_id, source || '_emo' AS topic, 'scenario' || doc_id AS scenario_id, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 3 AS VARCHAR) END AS dialogue_index, "
       r"source || '_emo_normal_scenario' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_' || (doc_id % 3) ELSE '' END AS conversation_id FROM documents")
def conversation_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    name = X.dialogue_id(F.concat("source", F.lit("_emo")), F.lit("normal"), F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 3))
    return docs.select("doc_id", *(c.cast("string").alias(n) for n, c in X.conversation_id(name).items()))


@query(r"SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'male' WHEN 3 THEN 'female' WHEN 4 THEN NULL WHEN 5 THEN 'other' END AS gender FROM customer")
def gender_norm(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 7
    raw = F.when(k == 0, " Male_masculine").when(k == 1, "F").when(k == 2, "man").when(k == 3, "female_feminine").when(k == 4, "  ").when(k == 5, "x")
    return table(spark, d, "customer").select("c_custkey", X.gender_norm(raw).alias("gender"))


@query(r"SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    """A value from an object that a model wrapped in prose and code fences."""
    reply = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone."))
    return table(spark, d, "events").select("event_id", F.from_json(X.strip(J.json_object_text(reply)), "k long")["k"].alias("k"))


@query(r"WITH b AS (SELECT event_id, event_id % 5 AS v, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events) "
       r"SELECT event_id, CASE v WHEN 0 THEN 'scenario1=a' || k || ';scenario2=b' WHEN 1 THEN 'scenario3=x y' WHEN 2 THEN 'scenario4=n' || k WHEN 3 THEN 'scenario5=' || k END AS found, "
       r"CASE v WHEN 4 THEN 'missing list of scenarios' WHEN 0 THEN NULL ELSE 'need at least 2 scenarios, got 1' END AS error FROM b")
def scenario_json_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Lists, maps by key, repeated nesting, strings as values, and no scenarios at all."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    v = F.col("event_id") % 5
    reply = (
        F.when(v == 0, F.concat(F.lit('{"scenarios":[{"scenario02":{"description":"b"}}, "loose", {"T_scenario1":{"description":" a'), "k", F.lit(' "}}]}')))
        .when(v == 1, F.lit('Sure: {"scenarios":[{"scenario3":{"description":"x\ny"}}]} ok'))
        .when(v == 2, F.concat(F.lit('{"scenario4":{"scenario4":{"description":"n'), "k", F.lit('"}}}')))
        .when(v == 3, F.concat(F.lit('{"scenarios":[{"scenario5":"'), "k", F.lit('"}, {"scenario6":{"description":" "}}]}')))
        .otherwise(F.lit('{"topics":[1]}'))
    )
    found = e.select("event_id", J.scenarios(J.json_object_text(reply)).alias("s"))
    return found.select("event_id", F.array_join(F.transform("s", lambda x: F.concat(x["id"], F.lit("="), x["description"])), ";").alias("found"), J.scenarios_error(F.col("s"), 2).alias("error"))


@query(
    r"WITH d AS (SELECT doc_id, source, lang, doc_id % 4 AS k, coalesce(source, 'unknown') AS label FROM documents) "
    r"SELECT doc_id, label AS topic, CASE WHEN k < 3 THEN 'scenario' || doc_id END AS base_scenario_id, CASE WHEN k < 3 THEN label || '_scenario' || doc_id ELSE 'notes' END AS scenario_id, "
    r"CASE WHEN k = 3 THEN lang ELSE coalesce(lang, '') END AS description FROM d"
)
def progress_items(spark: SparkSession, d: str) -> DataFrame:
    """Plain and labelled topics; numbers, names with a prefix and without, and a record without an index."""
    k, n = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    topic = F.when(k == 0, F.concat(F.lit(" Topic（"), "source", F.lit("）"))).otherwise(F.col("source"))
    scenario = F.when(k == 0, n).when(k == 1, F.concat(F.lit(" "), F.coalesce("source", F.lit("x")), F.lit("_scenario"), n)).when(k == 2, F.concat(F.lit("scenario"), n)).otherwise("notes")
    p = J.progress_item(topic, scenario, F.col("lang"))
    return table(spark, d, "documents").select("doc_id", *(c.alias(x) for x, c in p.items()))


@query(r"SELECT p_partkey, '[accent](' || p_brand || ') ' || p_name AS prompt, p_brand || '|' || p_brand || ' ' || p_type || '|' || p_brand || ' ' || p_type || ' ' || p_name AS growing, 'Use happy、sad for ' || p_name AS filled FROM part")
def reference_prompts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    grow = F.array_join(X.progressive_texts(F.array("p_brand", "p_type", "p_name")), "|")
    fill = X.fill_template(F.concat(F.lit("Use {EMOTION_LIST} for "), "p_name"), F.array(F.lit("happy"), F.lit("sad")))
    return p.select("p_partkey", X.reference_prompt(F.lit("accent"), F.concat(F.lit("("), "p_brand", F.lit(")")), F.col("p_name")).alias("prompt"), grow.alias("growing"), fill.alias("filled"))


@query(rf"WITH {TURNS} SELECT conv_id, turn_index, text AS content, string_agg(speaker || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history FROM turns")
def turn_history(spark: SparkSession, d: str) -> DataFrame:
    """Each turn with the dialogue before it (null for the first); a role prefix that a model
    repeated is stripped."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn_index").rowsBetween(Window.unboundedPreceding, -1)
    before = F.collect_list(F.concat("speaker", F.lit(": "), "text")).over(w)
    content = X.strip_role_prefix(F.concat("speaker", F.lit(":  "), "text"))
    return turns(spark, d).select("conv_id", "turn_index", content.alias("content"), F.when(F.size(before) > 0, F.array_join(before, "\n")).alias("history"))
