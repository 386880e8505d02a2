"""CSV feeds: required columns, lossless raw capture and routing of files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import keys, text, urls
from tidemark.operators.gates import require_columns


@dataclass(frozen=True)
class Feed:
    """name, source tag, columns that a file must have, and the column that names a row."""

    name: str
    source: str
    needs: tuple[str, ...]
    row_id: str | None = None


# Column names of the feeds.
FEEDS = {
    f.name: f
    for f in (
        Feed("owners", "owner_export", ("date_entered", "sku", "date_paid", "Paid Type", "ownername", "Name", "owner_address", "City", "owner_state", "ccode", "owner_zip", "owner_hphone", "owner_cphone", "Email", "org_name", "Club", "org_abbrev", "Yacht Name", "LOA"), "sku"),
        Feed("public_events", "public_scrape", ("source", "Event Name", "entries_url", "Host Club"), "entries_url"),
        Feed("public_entries", "public_scrape", ("source", "Event Name", "entries_url", "Fleet", "Name", "Yacht Name"), None),
        Feed("waivers", "waiver_form", ("Submission ID", "Submission Date", "Name", "Competitor E mail"), "Submission ID"),
        Feed("audience_subscribed", "audience", ("Email Address", "LAST_CHANGED"), "Email Address"),
        Feed("audience_unsubscribed", "audience", ("Email Address", "UNSUB_TIME"), "Email Address"),
        Feed("audience_cleaned", "audience", ("Email Address", "CLEAN_TIME"), "Email Address"),
        Feed("base_clubs", "base_copy", ("Name", "club_global_id"), "club_global_id"),
        Feed("base_events", "base_copy", ("Event Name", "source"), "event_global_id"),
        Feed("base_yachts", "base_copy", ("yachtName", "yacht_global_id"), "yacht_global_id"),
        Feed("base_owners", "base_copy", ("ownerName", "owner_global_id"), "owner_global_id"),
        Feed("base_participants", "base_copy", ("participant_global_id", "name", "competitorE"), "participant_global_id"),
        Feed("base_entries", "base_copy", ("entries_global_id", "source", "Event Name", "Name", "Yacht Name"), "entries_global_id"),
        Feed("race_events", "race_scoring", ("title-small href", "w-[20%]"), "title-small href"),
        Feed("race_entries", "race_scoring", ("title-small", "title-small href", "flex"), "title-small href"),
        Feed("race_entries_plain", "race_scoring", ("sailNumber", "entryUrl", "yachtName", "ownerName", "yachtType", "eventUrl"), "entryUrl"),
        Feed("race_yachts", "race_scoring", ("sailNumber", "yachtName", "yachtType"), None),
        Feed("unknown", "race_scoring", (), None),
        Feed("manual_decisions", "decisions", ("candidate_entity_type", "candidate_entity_id", "action", "actor"), None),
        Feed("merge_decisions", "decisions", ("canonical_entity_type", "keep_canonical_id", "merge_canonical_id", "reason_code", "actor"), None),
        Feed("demote_decisions", "decisions", ("candidate_entity_type", "candidate_entity_id", "reason_code", "actor"), None),
        Feed("split_decisions", "decisions", ("canonical_entity_type", "old_canonical_id", "candidate_entity_id", "reason_code", "actor"), None),
    )
}
#: The six files of a base copy, in the order in which they depend on each other.
BASE_ORDER = ("base_clubs", "base_events", "base_yachts", "base_owners", "base_participants", "base_entries")


def csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text; headers without outer white space; quoted fields may hold line breaks and doubled quotes.

    Columns are read from the header, unless given: then no job reads it.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def scan(spark: SparkSession, feed: str, path: str | Sequence[str]) -> DataFrame:
    """Rows of a feed with ``_source_file`` and ``_ordinal``, the order of files by name and of rows in them."""
    return numbered(require_columns(csv(spark, path), FEEDS[feed].needs))


def numbered(df: DataFrame) -> DataFrame:
    """Add ``_source_file`` and ``_ordinal``, a number that grows with the file's name and the row's place in it.

    A file with line breaks in fields is read by one task, so the lower 33 bits
    of Spark's own number grow inside it.
    """
    names = sorted(df.inputFiles())
    if not names:
        return df.withColumns({"_source_file": F.lit(""), "_ordinal": F.monotonically_increasing_id()})
    files = df.sparkSession.createDataFrame([(f, i) for i, f in enumerate(names)], "_source_file string, _file long")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = df.withColumns({"_source_file": F.input_file_name(), "_place": place})
    ordinal = F.shiftleft(F.coalesce("_file", F.lit(0).cast("long")), 33) + F.col("_place")
    return rows.join(F.broadcast(files), "_source_file", "left").withColumn("_ordinal", ordinal).select(*df.columns, "_source_file", "_ordinal")


def raw(df: DataFrame, feed: str) -> DataFrame:
    """Lossless copy of each row: source, feed, file, row id, payload and its hash; equal rows once."""
    f = FEEDS[feed]
    own = [c for c in df.columns if not c.startswith("_")]
    row_id = text.trimmed(F.col(f"`{f.row_id}`")) if f.row_id in df.columns else F.lit(None).cast("string")
    if not own:
        df, own = df.withColumn("row", F.lit(None).cast("string")), ["row"]
    rows = df.select(F.lit(f.source).alias("source_system"), F.lit(feed).alias("feed"), F.col("_source_file").alias("source_file"), row_id.alias("source_row_id"), keys.payload(*own).alias("payload"), "_ordinal")
    rows = rows.withColumn("row_hash", F.sha2("payload", 256))
    return rows.dropDuplicates(["source_system", "feed", "source_file", "row_hash"])


#: The three audience files: feed, status, and the column that dates it.
AUDIENCE = (("audience_subscribed", "subscribed", "LAST_CHANGED"), ("audience_unsubscribed", "unsubscribed", "UNSUB_TIME"), ("audience_cleaned", "cleaned", "CLEAN_TIME"))


def race_file_kind(path: str) -> str:
    """Kind of a race-scoring file by its place: scraped events, deduplicated or unique entries, scraped entries."""
    low = path.lower()
    if "scrapedevents" in low:
        return "race_events"
    if "unique" in low:
        return "race_yachts"
    if "dedup" in low:
        return "race_entries_plain"
    return "race_entries" if "scrapedentries" in low else "unknown"


#: Order in which kinds of race-scoring files build on each other; unknown ones are only kept raw.
RACE_ORDER = ("race_events", "race_entries_plain", "race_yachts", "race_entries", "unknown")


def discovered(spark: SparkSession, root: str) -> list[str]:
    """CSV files below a folder, however deep, in order of path; an empty folder gives none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    found, each = [], p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    while each.hasNext():
        name = each.next().getPath().toString()
        if name.lower().endswith(".csv"):
            found.append(name)
    return sorted(found)


def race_scan(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """Race-scoring files by kind, in order of path; files whose header doesn't fit their kind are ``unknown``, for raw capture only.

    Files of equal header are read together.
    """
    alike: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for path in sorted(paths):
        columns, kind = csv(spark, path).columns, race_file_kind(path)
        if kind != "unknown" and set(FEEDS[kind].needs) - set(columns):
            kind = "unknown"
        alike.setdefault((kind, tuple(columns)), []).append(path)
    parts: dict[str, list[DataFrame]] = {}
    for k, ((kind, columns), files) in enumerate(alike.items()):
        df = numbered(csv(spark, files, columns))
        parts.setdefault(kind, []).append(df.withColumn("_ordinal", F.col("_ordinal") + (k << 48)))
    out = {}
    for kind, dfs in parts.items():
        one = dfs[0]
        for df in dfs[1:]:
            one = one.unionByName(df, allowMissingColumns=True)
        out[kind] = one
    return out


def race_ids(kind: str, row_url: str = "title-small href", entry_url: str = "entryUrl", event_url: str = "eventUrl"):
    """Columns (event_id, entry_id) of a race-scoring row, by the kind of its file."""
    none = F.lit(None).cast("string")
    if kind == "race_yachts":
        return none, none
    if kind == "race_events":
        return F.coalesce(urls.number_after(F.col(f"`{row_url}`"), "emenu"), urls.number_after(F.col(f"`{row_url}`"), "current_event_entries")), none
    url = F.col(f"`{entry_url if kind == 'race_entries_plain' else row_url}`")
    pair = urls.number_pair_after(url, "boatdetail")
    if kind == "race_entries_plain":
        return F.coalesce(pair["event_id"], urls.number_after(F.col(event_url), "emenu"), urls.number_after(F.col(event_url), "current_event_entries")), pair["entry_id"]
    return pair["event_id"], pair["entry_id"]


def entry_status():
    """confirmed if paid or free, submitted if entered, else unknown."""
    from tidemark.functions.dates import timestamp

    return F.when(timestamp(F.col("date_paid")).isNotNull() | (F.lower(text.trimmed(F.col("Paid Type"))) == "free"), "confirmed").when(timestamp(F.col("date_entered")).isNotNull(), "submitted").otherwise("unknown")


def placeholder_club(name, abbreviation):
    """Names that stand for no club."""
    return F.coalesce(F.lower(text.trimmed(abbreviation)) == "rms", F.lit(False)) | text.trimmed(name).isNull() | F.lower(text.trimmed(name)).isin("-", "none", "n/a", "none/other", "other", "unaffiliated")
