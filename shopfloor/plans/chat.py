"""Chat ingest: raw JSON messages to curated rows, media manifest and customer ids.

The same functions serve batch frames and streams (see ``shopfloor.streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shopfloor.functions.columns import (
    clean_control,
    epoch_millis_text,
    guard_payload,
    is_blank,
    is_external_id,
    json_fields,
    json_text,
    valid_media_id,
)
from shopfloor.operators.aggregation import first_wins

# Media message types with their default file extension.
MEDIA_EXTENSIONS = {"image": "jpg", "voice": "mp3", "video": "mp4", "emotion": "gif"}
FILE_TYPE = "file"
OTHER_EXTENSION = "dat"

CURATED = ("seq", "msgid", "action", "sender", "receiver", "roomid", "msgtime", "msgtype", "sdkfileid", "md5sum", "raw_json")
CURATED_WITH_EXT = (*CURATED[:-1], "fileext", "raw_json")


def incremental_slice(feed: DataFrame, cursor: int | Column) -> DataFrame:
    """Rows from the cursor on. A Column (for example a scalar subquery) works too."""
    return feed.where(F.col("seq") >= cursor)


def next_cursor(batch: DataFrame, cursor: int) -> DataFrame:
    """One row: where the next slice starts, unchanged when the batch is empty."""
    return batch.agg(F.coalesce(F.max("seq") + 1, F.lit(cursor)).alias("next_seq"))


def is_media_type(msgtype: Column) -> Column:
    return F.lower(F.trim(msgtype)).isin(*MEDIA_EXTENSIONS, FILE_TYPE)


def _file_extension(payload: Column) -> Column:
    """Extension of a file payload; text holding an object such as {"fileext": "pdf"} is unwrapped."""
    text = json_text(json_fields(payload), "fileext")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(payload), "$.fileext", "variant"))
    wrapped = text.startswith("{") & text.endswith("}")
    inner = json_fields(text)
    unwrapped = F.when(inner.isNull(), "").otherwise(F.coalesce(F.try_element_at(inner, F.lit("fileext")), text))
    return F.when(kind.startswith("OBJECT"), "").when(wrapped, unwrapped).otherwise(text)  # a real object has no text of its own


def media_fields(msgtype: Column, payload: Column, min_media_id_chars: int | None = None) -> dict[str, Column]:
    """Media id, checksum and file extension of a payload, '' where absent; shorter ids than asked for count as absent."""
    fields = json_fields(payload)
    media_id = F.trim(json_text(fields, "sdkfileid"))
    if min_media_id_chars is not None:
        media_id = F.when(F.length(media_id) >= min_media_id_chars, media_id).otherwise("")
    return {
        "sdkfileid": F.when(is_media_type(msgtype), media_id).otherwise(""),
        "md5sum": json_text(fields, "md5sum"),
        "fileext": F.when(msgtype == FILE_TYPE, _file_extension(payload)).otherwise(""),
    }


def _parsed(feed: DataFrame) -> DataFrame:
    rows = feed.select("seq", "msgid", clean_control(F.col("message")).alias("_text"))
    return rows.withColumn("_m", json_fields(F.col("_text")))


def rejected_messages(feed: DataFrame) -> DataFrame:
    """Messages that are no JSON object, as they came: what ``normalize`` leaves out."""
    return _parsed(feed).where(F.col("_m").isNull()).select("seq", "msgid", F.col("_text").alias("message"))


def normalize_counts(feed: DataFrame) -> DataFrame:
    """One row: messages read, parsed and rejected."""
    return _parsed(feed).agg(*_message_counts())


def _message_counts() -> list[Column]:
    ok = F.col("_m").isNotNull()
    return [F.count(F.lit(1)).alias("messages_read"), F.count_if(ok).alias("messages_parsed"), F.count_if(~ok).alias("messages_rejected")]


def _receivers(text: Column, listed: Column) -> Column:
    """Receivers by the type of the list: elements of an array, '' without list, else the JSON text of the value."""
    value = F.try_variant_get(F.try_parse_json(text), "$.tolist", "variant")
    kind = F.schema_of_variant(value)
    return (
        F.when(listed.isNull(), F.array(F.lit("")))
        .when(kind.startswith("ARRAY"), F.from_json(listed, "array<string>"))
        .when(kind == "STRING", F.array(F.to_json(value)))
        .otherwise(F.array(listed))
    )


def normalize(
    feed: DataFrame,
    with_ext: bool = False,
    with_position: bool = False,
    max_record_chars: int | None = None,
    min_media_id_chars: int | None = None,
    counts: Observation | str | None = None,
) -> DataFrame:
    """One row per message and receiver from (seq, msgid, message JSON text).

    The receiver list decides the rows: an array gives one per element (none when empty), no
    list gives one with an empty receiver, any other value one holding its JSON text.
    Payloads and media ids stay whole unless limits are given. See ``rejected_messages`` for what is no message.
    ``counts`` receives the numbers of ``normalize_counts`` in the pass that writes the rows: an Observation for a batch,
    a name for a stream, whose progress then reports them for every micro-batch.
    """
    parsed = _parsed(feed)
    if counts is not None:
        parsed = parsed.observe(counts, *_message_counts())
    rows = parsed.where(F.col("_m").isNotNull())
    m = F.col("_m")
    receivers = _receivers(F.col("_text"), F.try_element_at(m, F.lit("tolist")))
    msgtype = json_text(m, "msgtype")
    rows = rows.select(
        "seq",
        "msgid",
        json_text(m, "action").alias("action"),
        json_text(m, "from").alias("sender"),
        json_text(m, "roomid").alias("roomid"),
        epoch_millis_text(F.coalesce(json_text(m, "msgtime").try_cast("bigint"), F.lit(0))).alias("msgtime"),
        msgtype.alias("msgtype"),
        json_text(m, msgtype).alias("_payload"),
        F.posexplode(receivers).alias("_position", "receiver"),
    )
    payload, kind = F.col("_payload"), F.col("msgtype")
    rows = rows.select(
        "*",
        *(c.alias(n) for n, c in media_fields(kind, payload, min_media_id_chars).items()),
        guard_payload(payload, kind, max_record_chars).alias("raw_json"),
    ).withColumn("receiver", F.coalesce("receiver", F.lit("null")))
    columns = CURATED_WITH_EXT if with_ext else CURATED
    return rows.select(*columns, *(["_position"] if with_position else []))


def _media_rows(curated: DataFrame) -> DataFrame:
    trimmed = {c: F.trim(F.col(c)) for c in ("msgtype", "sdkfileid", "md5sum", "fileext")}
    rows = curated.withColumns(trimmed)
    blank = is_blank(F.col("msgtype")) | is_blank(F.col("sdkfileid")) | is_blank(F.col("md5sum"))
    usable = ~blank & is_media_type(F.col("msgtype")) & valid_media_id(F.col("sdkfileid"))
    return rows.withColumn("_usable", F.coalesce(usable, F.lit(False)))


def _default_extension(msgtype: Column) -> Column:
    expr = F
    for kind, ext in MEDIA_EXTENSIONS.items():
        expr = expr.when(F.lower(msgtype) == kind, ext)
    return expr.otherwise(OTHER_EXTENSION)


def media_manifest(curated: DataFrame, counts: ManifestCounts | None = None) -> DataFrame:
    """Media files to fetch: valid rows, the first of each (type, checksum) by sequence.

    ``counts`` receives the numbers of ``manifest_counts`` in the pass that writes the manifest.
    """
    order = [c for c in ("seq", "_position", "receiver") if c in curated.columns]
    kind = F.col("msgtype")
    rows = _media_rows(curated)
    if counts is not None:
        rows = rows.observe(counts.read, F.count(F.lit(1)).alias("total"), F.count_if("_usable").alias("usable"))
    rows = rows.where("_usable")
    picked = first_wins(rows.select("msgtype", "sdkfileid", "md5sum", "fileext", *order), ["msgtype", "md5sum"], order)
    if counts is not None:
        picked = picked.observe(counts.kept, F.count(F.lit(1)).alias("files"))
    extension = F.when(kind == FILE_TYPE, F.col("fileext")).otherwise(_default_extension(kind))
    return picked.select("msgtype", "sdkfileid", "md5sum", extension.alias("fileext"))


class ManifestCounts:
    """Numbers of a manifest, known once it is written."""

    def __init__(self) -> None:
        self.read, self.kept = Observation(), Observation()

    @property
    def get(self) -> dict[str, int]:
        total, usable, files = self.read.get["total"], self.read.get["usable"], self.kept.get["files"]
        return {"total_rows": total, "valid_rows": files, "skipped_rows": total - usable, "duplicate_rows": usable - files}


def manifest_counts(curated: DataFrame) -> DataFrame:
    """One row: total, valid, skipped and duplicate media rows."""
    per_file = _media_rows(curated).groupBy("_usable", F.when(F.col("_usable"), F.struct("msgtype", "md5sum")).alias("_file")).agg(
        F.count(F.lit(1)).alias("n")
    )
    usable = F.col("_usable")
    zero = F.lit(0).cast("long")
    return per_file.agg(
        F.coalesce(F.sum("n"), zero).alias("total_rows"),
        F.count_if(usable).alias("valid_rows"),
        F.coalesce(F.sum(F.when(~usable, F.col("n"))), zero).alias("skipped_rows"),
        F.coalesce(F.sum(F.when(usable, F.col("n") - 1)), zero).alias("duplicate_rows"),
    )


def media_key(manifest: DataFrame, prefix: str = "raw/chat/media") -> DataFrame:
    """Object key of each media file; unlike the manifest this is case-sensitive on the type."""
    kind, ext = F.col("msgtype"), F
    for name, default in MEDIA_EXTENSIONS.items():
        ext = ext.when(kind == name, "." + default)
    ext = ext.when(kind == FILE_TYPE, F.concat(F.lit("."), F.col("fileext"))).otherwise("." + OTHER_EXTENSION)
    folder = F.when(kind.isin(*MEDIA_EXTENSIONS, FILE_TYPE), kind).otherwise("unknown")
    return manifest.withColumn("media_key", F.concat(F.lit(prefix + "/"), folder, F.lit("/"), F.col("md5sum"), ext))


def external_ids(curated: DataFrame) -> DataFrame:
    """Distinct customer ids seen as sender or receiver."""
    ids = curated.select(F.explode(F.array("sender", "receiver")).alias("external_userid"))
    return ids.where(is_external_id(F.col("external_userid"))).distinct()


def map_ids(ids: DataFrame, mapping: DataFrame) -> DataFrame:
    """Ids with a non-empty mapped id."""
    known = mapping.where(F.col("unionid").isNotNull() & (F.col("unionid") != ""))
    return ids.join(known, "external_userid").select("external_userid", "unionid")


def reconcile(source: DataFrame, staged: DataFrame) -> DataFrame:
    """Row counts of both sides and their difference, in one row."""
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    sides = source.select(one.alias("a"), zero.alias("b")).unionByName(staged.select(zero.alias("a"), one.alias("b")))
    total = sides.agg(F.coalesce(F.sum("a"), zero).alias("source_rows"), F.coalesce(F.sum("b"), zero).alias("staged_rows"))
    return total.withColumn("missing_rows", F.col("source_rows") - F.col("staged_rows"))
