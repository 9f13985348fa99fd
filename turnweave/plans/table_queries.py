"""Queries over turns, lookups, progress and partitions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import attempts as AT
from ..operators import lookups as L
from ..operators import progress as P
from ..operators import timeline as TL
from ..storage import scratch
from .inputs import LINES, TURNS, lines, table, turns

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# -- timelines -------------------------------------------------------------------------


@query(rf"WITH {TURNS} SELECT conv_id, turn_index, speaker, CAST(sum(frames) OVER w AS BIGINT) - frames AS start_frame, CAST(sum(frames) OVER w AS BIGINT) AS end_frame FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn_index)")
def clean_timeline(spark: SparkSession, d: str) -> DataFrame:
    return TL.clean_timeline(turns(spark, d)).select("conv_id", "turn_index", "speaker", "start_frame", "end_frame")


@query(
    rf"WITH {LINES}, m AS (SELECT *, sum(frames) OVER w AS e, max(CASE WHEN role LIKE '[%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS marked FROM lines WINDOW w AS (PARTITION BY conv_id ORDER BY turn_index)), "
    r"p AS (SELECT conv_id, min(text) AS system_prompt FROM conversations WHERE role = 'system' GROUP BY conv_id) "
    r"SELECT 'Chat_' || m.conv_id AS conversation_id, CAST(turn_index AS INTEGER) AS turn_index, role, CASE WHEN role LIKE '%User' THEN 'user' ELSE 'agent' END AS speaker, content AS text, system_prompt, "
    r"CAST((e - frames) / 24000.0 AS FLOAT) AS audio_start, CAST(e / 24000.0 AS FLOAT) AS audio_end, CAST(frames / 24000.0 AS FLOAT) AS audio_duration, "
    r"coalesce(nullif(lower(trim(regexp_extract(content, '(?i)^\s*\(\s*emotion\s*:\s*([^)]+)\)\s*', 1), ' ')), ''), 'neutral') AS emotion, 'wav/Chat_' || m.conv_id || '.wav' AS audio, "
    r"CASE WHEN marked = 1 THEN 'wav/Chat_' || m.conv_id || '_fx.wav' END AS audio_pause_overlap, '' AS emotion_reference, concat('{', chr(34), 'id', chr(34), ':', chr(34), h % 10, chr(34), '}') AS reference_metadata "
    r"FROM m LEFT JOIN p USING (conv_id)"
)
def turn_export(spark: SparkSession, d: str) -> DataFrame:
    """One row per turn for export; nested columns are given as strings."""
    return export_rows(spark, d).withColumn("emotion_reference", F.array_join("emotion_reference", ","))


def export_rows(spark: SparkSession, d: str) -> DataFrame:
    prompts = table(spark, d, "conversations").where("role = 'system'").groupBy("conv_id").agg(F.min("text").alias("system_prompt"))
    marked = F.max(F.col("role").startswith("[")).over(Window.partitionBy("conv_id"))
    t = TL.clean_timeline(lines(spark, d)).withColumn("marked", marked).join(prompts, "conv_id", "left")
    dialogue = F.concat(F.lit("Chat_"), F.col("conv_id").cast("string"))
    seconds = lambda c: (F.col(c) / float(TL.RATE)).cast("float")
    return t.select(
        dialogue.alias("conversation_id"),
        F.col("turn_index").cast("int").alias("turn_index"),
        "role",
        F.when(X.is_user(F.col("role")), "user").otherwise("agent").alias("speaker"),
        F.col("content").alias("text"),
        "system_prompt",
        seconds("start_frame").alias("audio_start"),
        seconds("end_frame").alias("audio_end"),
        seconds("frames").alias("audio_duration"),
        F.coalesce(X.leading_emotion(F.col("content")), F.lit("neutral")).alias("emotion"),
        F.concat(F.lit("wav/"), dialogue, F.lit(".wav")).alias("audio"),
        F.when(F.col("marked"), F.concat(F.lit("wav/"), dialogue, F.lit("_fx.wav"))).alias("audio_pause_overlap"),
        F.array().cast("array<string>").alias("emotion_reference"),
        F.to_json(F.struct((F.col("h") % 10).cast("string").alias("id"))).alias("reference_metadata"),
    )


@query(rf"WITH {LINES} SELECT conv_id, turn_index, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn_index) - 1 AS BIGINT) AS spoken_index FROM lines WHERE role NOT LIKE '[pause]%'")
def turn_index_no_pause(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn_index")) - 1
    return lines(spark, d).where(~X.is_pause(F.col("role"))).select("conv_id", "turn_index", i.cast("long").alias("spoken_index"))


_SEGMENTS = LINES + r""",
seg AS (SELECT conv_id, turn_index AS seg, role, CASE WHEN role LIKE '[pause]%' THEN 14400 + h % 9601 ELSE frames % 44400 END AS n, CAST(6000 AS BIGINT) AS gap,
        CASE WHEN role LIKE '[overlap]%' THEN 6000 + h % 40000 END AS shift, CAST(480 AS BIGINT) AS hold FROM lines)"""
_FOLD = _SEGMENTS + r""",
fx AS (
  SELECT conv_id, seg, role, CAST(0 AS BIGINT) AS start_frame, CAST(n AS BIGINT) AS end_frame, CAST(n AS BIGINT) AS len FROM seg WHERE seg = 0
  UNION ALL
  SELECT s.conv_id, s.seg, s.role,
    CAST(CASE WHEN s.shift IS NOT NULL THEN greatest(0, f.len - least(s.shift, s.n, f.len)) + s.hold ELSE f.len + s.gap END AS BIGINT),
    CAST(CASE WHEN s.shift IS NOT NULL THEN greatest(0, f.len - least(s.shift, s.n, f.len)) + s.hold ELSE f.len + s.gap END + s.n AS BIGINT),
    CAST(CASE WHEN s.shift IS NOT NULL THEN f.len - least(s.shift, s.n, f.len) + s.hold + s.n ELSE f.len + s.gap + s.n END AS BIGINT)
  FROM fx f JOIN seg s ON s.conv_id = f.conv_id AND s.seg = f.seg + 1)"""


def segments(spark: SparkSession, d: str) -> DataFrame:
    h, role = F.col("h"), F.col("role")
    n = F.when(X.is_pause(role), 14_400 + h % 9_601).otherwise(F.col("frames") % 44_400)
    shift = F.when(X.is_overlap(role), 6_000 + h % 40_000)
    return lines(spark, d).select("conv_id", F.col("turn_index").alias("seg"), "role", n.alias("frames"), F.lit(6_000).alias("gap"), shift.alias("shift"), F.lit(480).alias("hold"))


@query(rf"WITH RECURSIVE {_FOLD} SELECT conv_id, seg, start_frame, end_frame FROM fx")
def fx_timeline_fold(spark: SparkSession, d: str) -> DataFrame:
    return TL.effects_timeline(segments(spark, d)).select("conv_id", "seg", "start_frame", "end_frame")


@query(
    rf"WITH RECURSIVE {_FOLD}, t AS (SELECT *, max(len) FILTER (WHERE seg = mx) OVER (PARTITION BY conv_id) AS total FROM (SELECT *, max(seg) OVER (PARTITION BY conv_id) AS mx FROM fx)), "
    r"c AS (SELECT *, lag(role) OVER w AS prole, lag(start_frame) OVER w AS ps, lag(end_frame) OVER w AS pe, lead(role) OVER w AS nrole, lead(start_frame) OVER w AS ns FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY seg)), "
    r"x AS (SELECT conv_id, seg, role, total, CASE WHEN prole LIKE '[pause]%' AND pe <= start_frame THEN ps ELSE start_frame END AS a, CASE WHEN nrole LIKE '[overlap]%' THEN greatest(end_frame, ns + 8400) ELSE end_frame END AS z FROM c) "
    r"SELECT conv_id, seg, CAST(least(greatest(a, 0), total) AS BIGINT) AS slice_start, CAST(least(greatest(z, 0), total) AS BIGINT) AS slice_end FROM x WHERE role NOT LIKE '[pause]%' AND least(greatest(z, 0), total) > least(greatest(a, 0), total)"
)
def fx_slices(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d)
    t = TL.effects_timeline(s).join(s.select("conv_id", "seg", "role"), ["conv_id", "seg"])
    return TL.effects_slices(t).select("conv_id", "seg", "slice_start", "slice_end")


@query(rf"WITH {LINES} SELECT conv_id, coalesce(CASE WHEN conv_id % 3 = 0 THEN true WHEN conv_id % 3 = 1 THEN false END, bool_or(role LIKE '[pause]%' OR role LIKE '[overlap]%')) AS effects FROM lines GROUP BY conv_id")
def has_effects(spark: SparkSession, d: str) -> DataFrame:
    k, r = F.col("conv_id") % 3, F.col("role")
    rows = lines(spark, d).withColumn("policy", F.when(k == 0, True).when(k == 1, False))
    return P.effects_wanted(rows, "conv_id", "policy", X.is_pause(r) | X.is_overlap(r))


# -- filters and lookups ---------------------------------------------------------------


@query(r"SELECT c_custkey, c_nationkey, c_mktsegment FROM customer c WHERE c_mktsegment = 'BUILDING' OR NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_nationkey = c.c_nationkey AND x.c_mktsegment = 'BUILDING')")
def filter_fallback(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return L.filter_or_all(c, F.col("c_mktsegment") == "BUILDING", ["c_nationkey"])


@query(r"SELECT doc_id, n_chars, CASE WHEN n_chars < 200 THEN 'TOO SHORT' ELSE 'TOO LONG' END AS flag FROM documents WHERE NOT n_chars BETWEEN 200 AND 5000")
def duration_audit(spark: SparkSession, d: str) -> DataFrame:
    return P.audit(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", 200, 5000)


@query(r"SELECT count(*) AS total, count(*) FILTER (WHERE NOT n_chars BETWEEN 200 AND 5000) AS out_of_range FROM documents")
def duration_summary(spark: SparkSession, d: str) -> DataFrame:
    return P.audit_summary(table(spark, d, "documents"), "n_chars", 200, 5000)


@query(r"SELECT rpad(CAST(doc_id AS VARCHAR), 60, ' ') || lpad(CAST(n_chars AS VARCHAR) || '.00', 10, ' ') || '  ' || CASE WHEN n_chars < 200 THEN 'TOO SHORT' ELSE 'TOO LONG' END AS line FROM documents WHERE NOT n_chars BETWEEN 200 AND 5000")
def audit_report(spark: SparkSession, d: str) -> DataFrame:
    return P.report_lines(duration_audit(spark, d), "doc_id", "n_chars", "flag")


@query(r"SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice BETWEEN 950.01 AND 1449.99 AND p_brand <> 'Brand#11'")
def accepted_range(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.where(F.col("p_retailprice").between(950.01, 1449.99) & ~F.col("p_brand").isin("Brand#11")).select("p_partkey", "p_retailprice")


@query(r"SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_whitelist(spark: SparkSession, d: str) -> DataFrame:
    return L.listed(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").where("quality = 1"), "doc_id")


@query(r"SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_pending(spark: SparkSession, d: str) -> DataFrame:
    return L.pending(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query(rf"WITH {TURNS} SELECT conv_id, turn_index, s.description FROM turns LEFT JOIN (SELECT doc_id, 'quality ' || quality AS description FROM labels) s ON turns.conv_id = s.doc_id")
def scenario_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Turns with their scenario's description, which only labelled ones have."""
    s = table(spark, d, "labels").select(F.concat(F.lit("Chat_scenario"), F.col("doc_id").cast("string")).alias("name"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("description"))
    s = s.select(X.canonical_scenario_id(F.col("name")).alias("scenario_id"), "description")
    t = turns(spark, d).withColumn("scenario_id", F.concat(F.lit("scenario"), F.col("conv_id").cast("string")))
    return L.with_default(t, s, "scenario_id", {"description": None}).select("conv_id", "turn_index", "description")


@query(r"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def defaulted_join(spark: SparkSession, d: str) -> DataFrame:
    return L.with_default(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", {"quality": -1, "toxic": -1})


@query(
    r"WITH c AS (SELECT doc_id, 1 AS r, 'filler/' || doc_id AS path FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 2, 'overlap/' || doc_id FROM documents WHERE lang IN ('en', 'fr') "
    r"UNION ALL SELECT doc_id, 3, 'dialogue/' || doc_id FROM documents WHERE lang <> 'es') "
    r"SELECT d.doc_id, (SELECT arg_min(path, r) FROM c WHERE c.doc_id = d.doc_id) AS path FROM documents d"
)
def stage_priority(spark: SparkSession, d: str) -> DataFrame:
    """Each dialogue's text from the first stage that has one; which stages have is told by the language."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    part = lambda cond, r, n: docs.where(cond).select("doc_id", F.lit(r).alias("r"), F.concat(F.lit(n + "/"), F.col("doc_id").cast("string")).alias("path"))
    c = part("lang = 'en'", 1, "filler").unionByName(part("lang IN ('en', 'fr')", 2, "overlap")).unionByName(part("lang <> 'es'", 3, "dialogue"))
    return L.first_by_priority(docs.select("doc_id"), c, ["doc_id"], ["r"]).select("doc_id", "path")


_CLIPS = "(SELECT s_suppkey, 'spk' || s_nationkey % 5 AS speaker, 'emo' || s_suppkey % 4 AS emotion, 'c' || s_suppkey AS clip FROM supplier)"


@query(
    rf"WITH {TURNS}, clips AS {_CLIPS}, t AS (SELECT conv_id, turn_index, h, 'spk' || (h % 7) AS speaker, 'emo' || (h % 6) AS emotion FROM turns), "
    r"a AS (SELECT emotion, speaker, list(DISTINCT clip) AS l FROM clips GROUP BY ALL), b AS (SELECT speaker, list(DISTINCT clip) AS l FROM clips GROUP BY ALL), e AS (SELECT list(DISTINCT clip) AS l FROM clips), "
    r"j AS (SELECT conv_id, turn_index, h, list_sort(coalesce(a.l, b.l, e.l)) AS l, CASE WHEN a.l IS NOT NULL THEN 0 WHEN b.l IS NOT NULL THEN 1 ELSE 2 END AS tier FROM t LEFT JOIN a USING (emotion, speaker) LEFT JOIN b USING (speaker) CROSS JOIN e) "
    r"SELECT conv_id, turn_index, l[CAST(h % len(l) AS BIGINT) + 1] AS chosen, tier FROM j"
)
def ref_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A reference clip for each turn: of its emotion and speaker, else its speaker, else any."""
    k = F.col("s_suppkey")
    clips = table(spark, d, "supplier").select(
        F.concat(F.lit("spk"), (F.col("s_nationkey") % 5).cast("string")).alias("speaker"), F.concat(F.lit("emo"), (k % 4).cast("string")).alias("emotion"), F.concat(F.lit("c"), k.cast("string")).alias("clip")
    )
    h = F.col("h")
    t = turns(spark, d).select("conv_id", "turn_index", "h", F.concat(F.lit("spk"), (h % 7).cast("string")).alias("speaker"), F.concat(F.lit("emo"), (h % 6).cast("string")).alias("emotion"))
    return L.tiered_choice(t, clips, [["emotion", "speaker"], ["speaker"], []], "clip", h).select("conv_id", "turn_index", "chosen", "tier")


@query(
    r"WITH p AS (SELECT list_sort(list(DISTINCT s_name)) AS l FROM supplier), c AS (SELECT DISTINCT conv_id FROM conversations), "
    r"x AS (SELECT conv_id, l, ('0x' || substr(md5('first:' || conv_id), 1, 8))::BIGINT % len(l) AS i, ('0x' || substr(md5('second:' || conv_id), 1, 8))::BIGINT % (len(l) - 1) AS k FROM c CROSS JOIN p) "
    r"SELECT conv_id, l[CAST(i AS BIGINT) + 1] AS user_speaker, l[CAST((i + 1 + k) % len(l) AS BIGINT) + 1] AS agent_speaker FROM x"
)
def two_speakers(spark: SparkSession, d: str) -> DataFrame:
    return L.two_distinct(table(spark, d, "conversations").select("conv_id").distinct(), "conv_id", table(spark, d, "supplier"), "s_name")


@query(
    r"SELECT 'emo' || e.i || '_spk' || s.i || '_' || v.i AS name, CAST(e.i AS VARCHAR) AS emotion FROM range(26) e(i), range(10) s(i), range(1, 4) v(i) UNION ALL SELECT 'spk' || s.i || '_' || v.i, NULL FROM range(10) s(i), range(1, 4) v(i)"
)
def emotion_grid(spark: SparkSession, d: str) -> DataFrame:
    """All speakers, emotions and variants, and the neutral ones."""
    dim = lambda n, name, lo=0: spark.range(lo, n).withColumnRenamed("id", name)
    named = L.grid(dim(26, "e"), dim(10, "s"), dim(4, "v", 1)).select(F.format_string("emo%d_spk%d_%d", "e", "s", "v").alias("name"), F.col("e").cast("string").alias("emotion"))
    plain = L.grid(dim(10, "s"), dim(4, "v", 1)).select(F.format_string("spk%d_%d", "s", "v").alias("name"), F.lit(None).cast("string").alias("emotion"))
    return named.unionByName(plain)


@query(r"SELECT topic, topic IN (SELECT n_name FROM nation JOIN customer ON n_nationkey = c_nationkey) AS available FROM (SELECT n_name AS topic FROM nation UNION SELECT r_name FROM region)")
def topic_missing(spark: SparkSession, d: str) -> DataFrame:
    """Nations and regions are asked for; those that any customer has are there."""
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("topic"))
    have = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct().join(L.small(n), "n_nationkey").select("topic")
    return L.request_status(n.select("topic").union(table(spark, d, "region").select("r_name")), have, "topic")


# -- aggregates ------------------------------------------------------------------------


@query(r"SELECT source AS topic, max(greatest(doc_id, coalesce(turn, 0))) + 1 AS next_index FROM documents LEFT JOIN conversations ON conv_id = doc_id GROUP BY source")
def next_index(spark: SparkSession, d: str) -> DataFrame:
    """After the largest index of file names and of progress records (the turns of dialogues)."""
    docs = table(spark, d, "documents").select(F.col("source").alias("topic"), "doc_id")
    names = docs.select("topic", X.scenario_index_in_name(F.concat("topic", F.lit("_scenario"), F.col("doc_id").cast("string"), F.lit("_1"))).alias("i"))
    items = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("i")).join(docs, "doc_id").select("topic", "i")
    return P.next_index(items, names, key="topic", index="i")


@query(r"SELECT source AS topic, count(*) AS n, max(doc_id) + 1 AS next_scenario_index, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def topic_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.col("source").alias("topic")).agg(F.count(F.lit(1)).alias("n"), (F.max("doc_id") + 1).alias("next_scenario_index"), F.sum("n_chars").alias("chars"))


@query(r"SELECT s_nationkey AS speaker, string_agg(s_name, ',' ORDER BY s_name) AS clips FROM supplier GROUP BY s_nationkey")
def ref_multimap(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("speaker")).agg(F.array_join(F.sort_array(F.collect_list("s_name")), ",").alias("clips"))


@query(
    r"WITH o AS (SELECT doc_id, max(CASE WHEN toxic = 1 THEN '' ELSE 'quality ' || quality END) AS description FROM labels GROUP BY doc_id), "
    r"n AS (SELECT doc_id, arg_min(lang, n_chars) FILTER (WHERE lang <> 'de') AS v, arg_min(CASE WHEN lang = 'de' THEN ' ' ELSE lang END, n_chars) AS f FROM documents GROUP BY doc_id) "
    r"SELECT doc_id, CASE WHEN trim(coalesce(description, '')) = '' AND v IS NOT NULL THEN v ELSE coalesce(description, f) END AS description FROM o FULL JOIN n USING (doc_id)"
)
def progress_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Labels are the records so far, blank where toxic; documents are new ones, blank in German."""
    old = table(spark, d, "labels").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, "").otherwise(F.concat(F.lit("quality "), F.col("quality").cast("string")))).alias("description"))
    new = table(spark, d, "documents").select("doc_id", "n_chars", F.when(F.col("lang") == "de", " ").otherwise(F.col("lang")).alias("description"))
    return P.upsert_fill(old, new, ["doc_id"], "description", "n_chars")


@query(r"SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_key FROM documents GROUP BY text HAVING count(*) > 1")
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return P.exact_duplicates(table(spark, d, "documents"), "text", "doc_id")


@query(r"SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY user_id")
def failure_counts(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_type") == "error"
    return table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(e).alias("failed"), F.count_if(~e).alias("ok"))


@query(r"SELECT source AS topic, count(*) >= 40 AS enough, count(*) > count(DISTINCT text) AS repeats FROM documents GROUP BY source")
def scenario_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether a topic has enough descriptions, and whether any repeats."""
    h = F.md5("text")
    return table(spark, d, "documents").groupBy(F.col("source").alias("topic")).agg((F.count(F.lit(1)) >= 40).alias("enough"), (F.count(F.lit(1)) > F.count_distinct(h)).alias("repeats"))


@query(rf"WITH {TURNS} SELECT conv_id, turn_index, score, CAST(rank AS INTEGER) AS rank FROM (SELECT conv_id, turn_index, CAST(length(text) AS BIGINT) AS score, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn_index) AS rank FROM turns) WHERE rank <= 2")
def judge_topk(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("conv_id", "turn_index", F.length("text").cast("long").alias("score"))
    return P.top_k(t, ["conv_id"], [F.desc("score"), F.asc("turn_index")], 2)


@query(rf"WITH {TURNS}, s AS (SELECT conv_id, turn_index, CASE WHEN h % 9 = 0 THEN NULL ELSE turn_index END AS i FROM turns) SELECT conv_id, turn_index, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN i IS NULL THEN 2000000000 WHEN i = 0 THEN 1000000000 ELSE i END, turn_index) AS INTEGER) AS place FROM s")
def numeric_sort_rank(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("h") % 9 == 0, F.lit("notes")).otherwise(F.concat(F.lit("Chat_scenario"), F.col("turn_index").cast("string")))
    t = turns(spark, d).withColumn("i", X.scenario_index_in_name(name))
    w = Window.partitionBy("conv_id").orderBy(P.numeric_rank(F.col("i")), "turn_index")
    return t.select("conv_id", "turn_index", F.row_number().over(w).alias("place"))


@query(
    r"SELECT event_id, user_id, count(*) OVER w AS done, count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) OVER w AS generated, count(*) FILTER (WHERE event_type IN ('view', 'click')) OVER w AS skipped, "
    r"count(*) FILTER (WHERE event_type = 'error') OVER w AS failed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
)
def progress_counters(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    states = {"generated": t.isin("purchase", "signup"), "skipped": t.isin("view", "click"), "failed": t == "error"}
    return P.running_counters(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], states).select("event_id", "user_id", "done", *states)


@query(r"SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    """The first occurrence of each value."""
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    return e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id", "event_type")


# -- sets and partitions ---------------------------------------------------------------


@query(r"SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS BIGINT) AS worker FROM orders")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    return P.round_robin(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", [], 7)


@query(r"SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 100) AS BIGINT) AS chunk FROM orders")
def chunks(spark: SparkSession, d: str) -> DataFrame:
    return P.chunks(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", [], 100)


@query(r"WITH t AS (SELECT o_orderpriority AS topic, count(*) AS total FROM orders GROUP BY 1) SELECT topic, total, CAST(b.i AS BIGINT) AS batch, least(130, total - (b.i - 1) * 130) AS batch_size FROM t, range(1, 100000) b(i) WHERE b.i <= ceil(total / 130.0)")
def batches(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("topic")).agg(F.count(F.lit(1)).alias("total"))
    return P.batches(t, "total", 130).withColumn("batch", F.col("batch").cast("long"))


@query(r"SELECT doc_id, lang, CAST(n_chars AS VARCHAR) AS n_chars, NULL AS source FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang, NULL, source FROM documents WHERE lang <> 'en'")
def union_topics(spark: SparkSession, d: str) -> DataFrame:
    """Exports of different columns as one table."""
    docs = table(spark, d, "documents")
    return docs.where("lang = 'en'").select("doc_id", "lang", F.col("n_chars").cast("string").alias("n_chars")).unionByName(docs.where("lang <> 'en'").select("doc_id", "lang", "source"), allowMissingColumns=True)


@query(r"SELECT DISTINCT c_nationkey AS k, 'both' AS side FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier) UNION ALL SELECT DISTINCT c_nationkey, 'left' FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"))
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.distinct().exceptAll(b.distinct()).withColumn("side", F.lit("left")))


@query(r"SELECT i AS attempt, CAST(least(300.0, pow(2.0, i - 1)) AS DOUBLE) AS wait_seconds FROM range(1, 21) r(i)")
def backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1, 21).select(F.col("id").alias("attempt"), P.backoff(F.col("id"), 2.0, 300.0).alias("wait_seconds"))


@query(
    r"WITH d AS (SELECT doc_id, ('0x' || substr(md5('call:' || doc_id), 1, 8))::BIGINT AS h FROM documents), x AS (SELECT *, CAST(h % 5 AS INTEGER) AS fails, h % 11 = 0 AS broken FROM d) "
    r"SELECT doc_id, CASE WHEN broken AND fails < 3 THEN 'fatal' WHEN fails < 3 THEN 'done' ELSE 'exhausted' END AS state, CAST(least(fails + 1, 3) AS INTEGER) AS attempts, "
    r"CASE WHEN NOT broken AND fails < 3 THEN 'reply ' || doc_id END AS reply, CASE WHEN fails >= 3 THEN 'HTTP 503' WHEN broken THEN 'HTTP 400' END AS error FROM x"
)
def retried_calls(spark: SparkSession, d: str) -> DataFrame:
    """One request for each document to a service that fails in passing 0 to 4 times, and for good for some."""
    h = X.keyed_draw(F.lit("call"), F.col("doc_id"))

    def service(pending: DataFrame, attempt: int) -> DataFrame:
        status = F.when(h % 5 >= attempt, 503).when(h % 11 == 0, 400).otherwise(200)
        failed = status != 200
        return pending.select("doc_id", F.when(~failed, F.concat(F.lit("reply "), F.col("doc_id").cast("string"))).alias("reply"), status.alias("status"), F.when(failed, F.concat(F.lit("HTTP "), status.cast("string"))).alias("error"))

    return AT.run_attempts(table(spark, d, "documents").select("doc_id"), service, scratch(spark, "attempts"), "doc_id", max_attempts=3, sleep=lambda s: None)


@query(r"SELECT doc_id, CASE WHEN lang = 'de' OR lang IS NULL THEN coalesce('heard ' || substr(sha256(text), 1, 8), lang) ELSE lang END AS sentence FROM documents")
def memo_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """German documents are clips without a sentence; each distinct text is transcribed once."""
    clips = table(spark, d, "documents").select("doc_id", F.col("text").alias("content"), F.when(F.col("lang") == "de", " ").otherwise(F.col("lang")).alias("sentence"))
    service = lambda one: one.select("digest", F.concat(F.lit("heard "), F.substring("digest", 1, 8)).alias("answer"))
    return AT.fill_once(clips, service, scratch(spark, "transcripts")).select("doc_id", "sentence")


@query(
    r"WITH c AS (SELECT DISTINCT conv_id FROM conversations), n AS (SELECT conv_id, 12 + ('0x' || substr(md5('turns:' || conv_id), 1, 8))::BIGINT % 4 AS n FROM c), "
    r"p AS (SELECT conv_id, CAST(unnest(range(n)) AS BIGINT) AS turn FROM n) SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'User' ELSE 'Agent' END AS speaker, "
    r"('0x' || substr(md5('emotion:' || conv_id || ':' || turn), 1, 8))::BIGINT < 2147483648 AS with_emotion, turn > 0 AND turn % 2 = 0 AND ('0x' || substr(md5('back:' || conv_id || ':' || turn), 1, 8))::BIGINT < 858993459 AS backchannel FROM p"
)
def plan_of_turns(spark: SparkSession, d: str) -> DataFrame:
    """Which speaker takes which turn, with emotion and backchannel flags by keyed draws."""
    c = table(spark, d, "conversations").select("conv_id").distinct()
    n = 12 + X.keyed_draw(F.lit("turns"), F.col("conv_id")) % 4
    p = c.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("turn"))
    user = F.col("turn") % 2 == 0
    draw = lambda what: X.keyed_draw(F.lit(what), F.col("conv_id"), F.col("turn"))
    return p.select("conv_id", "turn", F.when(user, "User").otherwise("Agent").alias("speaker"), (draw("emotion") < 1 << 31).alias("with_emotion"), ((F.col("turn") > 0) & user & (draw("back") < 858_993_459)).alias("backchannel"))


# -- references and metadata -----------------------------------------------------------


@query(
    r"SELECT s.s_suppkey, coalesce(n.n_name, CAST(s.s_nationkey AS VARCHAR)) AS display_name, coalesce(p.p_name, '') AS transcription FROM supplier s "
    r"LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON s.s_nationkey = n.n_nationkey LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON s.s_suppkey = p.p_partkey"
)
def reference_registry(spark: SparkSession, d: str) -> DataFrame:
    """Nations of one region are in no registry, and large parts have no transcription."""
    clips = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    names = table(spark, d, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("display_name"))
    said = table(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("s_suppkey"), F.col("p_name").alias("transcription"))
    return L.with_registry(clips, names, said, "s_nationkey", "s_suppkey").select("s_suppkey", "display_name", "transcription")


@query(
    rf"WITH {LINES}, s AS (SELECT conv_id, turn_index, role LIKE '[pause]%' AS skip, sum(CASE WHEN role LIKE '[pause]%' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn_index) - 1 AS k FROM lines) "
    r"SELECT conv_id, turn_index, CASE WHEN NOT skip THEN 'wav/' || conv_id || '/' || CAST(k AS BIGINT) || '.wav' END AS audio FROM s"
)
def segment_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Timeline segments with the recording of their place; pauses have none."""
    rows = lines(spark, d)
    spoken = turn_index_no_pause(spark, d).select("conv_id", F.col("spoken_index").alias("place"))
    path = F.concat(F.lit("wav/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("place").cast("string"), F.lit(".wav"))
    return L.zip_segments(rows, spoken.withColumn("audio", path), "conv_id", "turn_index", X.is_pause(F.col("role"))).select("conv_id", "turn_index", "audio")


@query(
    r"WITH f AS (SELECT 'd' || s_nationkey % 5 AS folder, 'd' || s_nationkey % 5 || '/s' || s_suppkey || CASE WHEN s_suppkey % 4 = 0 THEN '.txt' ELSE '.wav' END AS path FROM supplier UNION ALL SELECT 'notes', 'notes/a.txt'), "
    r"u AS (SELECT DISTINCT * FROM f WHERE path LIKE '%.wav'), o AS (SELECT folder, list_sort(list(path)) AS l FROM u GROUP BY folder), e AS (SELECT list_sort(list(path)) AS l FROM u), "
    r"q AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'd' || c_nationkey % 5 || '/s' || c_custkey % 100 || '.wav' WHEN 1 THEN 'd' || c_nationkey % 7 WHEN 2 THEN '' WHEN 3 THEN 'notes' END AS request FROM customer), "
    r"r AS (SELECT c_custkey, nullif(request, '') AS request, o.l AS own, e.l AS pool FROM q LEFT JOIN o ON q.request = o.folder CROSS JOIN e) "
    r"SELECT c_custkey, CASE WHEN request IS NULL THEN pool[CAST(c_custkey % len(pool) AS BIGINT) + 1] WHEN request IN (SELECT path FROM f) THEN request ELSE own[CAST(c_custkey % len(own) AS BIGINT) + 1] END AS recording, "
    r"CASE WHEN request IS NULL OR request IN (SELECT path FROM f) OR own IS NOT NULL THEN NULL WHEN request IN (SELECT folder FROM f) THEN 'no recordings in folder: ' || request ELSE 'no such path: ' || request END AS error FROM r"
)
def speaker_resolver(spark: SparkSession, d: str) -> DataFrame:
    """A named file, a drawn file of a named folder, one of all where nothing is asked for, or an error."""
    s, n = F.col("s_suppkey"), (F.col("s_nationkey") % 5).cast("string")
    files = table(spark, d, "supplier").select(F.concat(F.lit("d"), n, F.lit("/s"), s.cast("string"), F.when(s % 4 == 0, ".txt").otherwise(".wav")).alias("path"))
    files = files.unionByName(spark.createDataFrame([("notes/a.txt",)], "path string"))
    k, c = F.col("c_custkey"), F.col("c_nationkey")
    request = F.when(k % 5 == 0, F.concat(F.lit("d"), (c % 5).cast("string"), F.lit("/s"), (k % 100).cast("string"), F.lit(".wav"))).when(k % 5 == 1, F.concat(F.lit("d"), (c % 7).cast("string"))).when(k % 5 == 2, "").when(k % 5 == 3, "notes")
    asked = table(spark, d, "customer").select("c_custkey", request.alias("request"))
    return L.resolve_speaker(asked, files, files.where("path like '%.wav'"), "request", k).select("c_custkey", "recording", "error")


@query(r"SELECT p_partkey, p_brand AS key, CASE WHEN p_partkey % 2 = 0 THEN 'no provider in model name: ' || p_brand END AS error, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE '' END AS emotions FROM part")
def config_values(spark: SparkSession, d: str) -> DataFrame:
    """Keys without quotes, model names checked, a value as a list."""
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.col("p_brand")).otherwise(F.concat(F.lit("lab/"), "p_brand"))
    listed = X.as_list(F.when(k % 3 == 0, F.col("p_type")).when(k % 3 == 1, F.lit(" ")))
    return table(spark, d, "part").select("p_partkey", X.strip_quotes(F.concat(F.lit(" \"'"), "p_brand", F.lit("'\" "))).alias("key"), X.model_name_error(name).alias("error"), F.array_join(listed, ",").alias("emotions"))
