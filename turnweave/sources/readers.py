"""Readers: JSON, JSON lines, tab-separated corpora, whitelists, text folders, audio folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.audio import wav_header
from ..functions.text import gender_norm, none_if_empty, parse_stem, scenario_index_in_name, strip

#: Columns of a clip corpus table.  Fixed values.
CORPUS_COLUMNS = ["client_id", "path", "sentence_id", "sentence", "sentence_domain", "up_votes", "down_votes", "age", "gender", "accents", "variant", "locale", "segment"]


def read_json_object(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per file; missing or broken files and other values give no rows."""
    try:
        rows = spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True, mode="PERMISSIVE")
    except AnalysisException:
        return spark.createDataFrame([], T._parse_datatype_string(schema))
    return rows.cache().where("_corrupt is null").drop("_corrupt")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_corpus(spark: SparkSession, path: str, columns: list[str] = CORPUS_COLUMNS) -> DataFrame:
    """A tab-separated table with a header, all strings, blanks as null; quotes count."""
    raw = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True)
    have = set(raw.columns)
    return raw.select(*(none_if_empty(strip(F.col(c))).alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns))


def corpus_clips(corpus: DataFrame, folder: str) -> DataFrame:
    """Reference clips: path, id, normalised gender and the other columns as a map."""
    meta = F.map_filter(F.create_map(*(x for c in corpus.columns for x in (F.lit(c), F.col(c)))), lambda k, v: v.isNotNull())
    return corpus.where("path is not null").select(F.concat(F.lit(folder.rstrip("/") + "/"), "path").alias("audio_path"), F.coalesce("client_id", "path").alias("reference_id"), gender_norm(F.col("gender")).alias("gender_norm"), meta.alias("metadata"))


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a table with a header, trimmed, blanks left out."""
    raw = spark.read.csv(path, sep="\t", header=True)
    return raw.select(strip(F.col(f"`{raw.columns[0]}`")).alias("path")).where("path <> ''").distinct()


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def _plain(path: Column) -> Column:
    """A file's path without the escapes of a URL."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Text files of a folder tree: path, the parts of the stem, and the whole text; empty files give no row."""
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True).select(_plain(F.input_file_name()).alias("path"), F.col("value").alias("text"))
    return t.select("path", *(c.alias(n) for n, c in parse_stem(file_stem(F.col("path"))).items()), "text")


def parse_wav_name(stem: Column) -> dict[str, Column]:
    """``emotion, speaker, variant`` of ``emotion_speaker_n`` or ``speaker_n``."""
    parts = F.split(stem, "_")
    n = F.size(parts)
    return {
        "emotion": F.when(n >= 3, F.array_join(F.slice(parts, F.lit(1), n - 2), "_")),
        "speaker": F.when(n >= 2, F.element_at(parts, -2)),
        "variant": F.element_at(parts, -1).try_cast("int") if hasattr(Column, "try_cast") else F.element_at(parts, -1).cast("int"),
    }


def read_reference_wavs(spark: SparkSession, path: str, excluded: tuple[str, ...] = ("bella",)) -> DataFrame:
    """Reference recordings of a folder tree, without some speakers; content stays unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(path).select("path", "length")
    return files.select("path", "length", *(c.alias(n) for n, c in parse_wav_name(file_stem(F.col("path"))).items())).where(~F.coalesce(F.col("speaker").isin(*excluded), F.lit(False)))


def read_wavs(spark: SparkSession, path: str) -> DataFrame:
    """WAV files of a folder tree, for decoding: ``path, length, content``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(path)
    return files.select(_plain(F.col("path")).alias("path"), "length", "content")


#: Leading bytes that a header is looked for in.
HEADER_BYTES = 1 << 16


def read_wav_durations(spark: SparkSession, path: str) -> DataFrame:
    """What each file's header says, null where it can't be read: ``path, channels, rate, bits, frames,
    seconds, whole``.  Samples leave the scan with nothing but their file's leading bytes."""
    w = read_wavs(spark, path).select("path", "length", F.substring("content", 1, HEADER_BYTES).alias("head"))
    return w.select("path", wav_header(F.col("head"), F.col("length")).alias("w")).select("path", "w.*")


def largest_index(names: DataFrame, column: str) -> DataFrame:
    return names.agg(F.coalesce(F.max(scenario_index_in_name(F.col(column))), F.lit(0)).alias("largest"))


def partitions_with_rows(rows: DataFrame, key: str) -> DataFrame:
    """Keys that have any row: the topics that can be exported."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct()


def discover_topics(spark: SparkSession, run_root: str, data_root: str, mode: str = "normal", fallback_root: str | None = None, hidden: bool = False) -> DataFrame:
    """``topic``: the folders of ``run_root/data_root/mode``, or of ``fallback_root`` in place of ``data_root`` where
    that is not there.  No such folder, or one without topics, is an error.  Only folder names are read."""
    bases = [f"{run_root.rstrip('/')}/{r.strip('/')}/{mode}" for r in (data_root, fallback_root) if r]
    for base in bases:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
            names = [n for n in names if hidden or not n.startswith(".")]
            if not names:
                raise ValueError(f"no topics under: {base}")
            return spark.createDataFrame([(n,) for n in names], "topic string")
    raise FileNotFoundError(f"no folder of topics: {' or '.join(bases)}")
