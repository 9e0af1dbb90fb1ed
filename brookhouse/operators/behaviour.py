"""Behaviour log: cleansing, new-visitor repair and the split into five topics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.functions.dates import DAY_MS, day_of
from brookhouse.functions.jsons import parse_objects
from brookhouse.operators.joins import interval_join
from brookhouse.operators.sizing import fits, materialise
from brookhouse.operators.skew import NO_SALT, Salt


def clean_log(raw: DataFrame, schema=S.BEHAVIOUR_LOG) -> DataFrame:
    """Page and start records with a device and a time.

    The typed columns are what the operators look at; `whole` is the record as it came, with all its fields. (Of a record
    that names a field twice, which a variant cannot hold, it is what the typed columns say.)
    """
    parsed = parse_objects(raw.withColumn("whole", F.try_parse_json("value")), schema)
    parsed = parsed.withColumn("ts", F.col("ts").try_cast("bigint"))
    typed = F.try_parse_json(F.to_json(F.struct(*schema.fieldNames())))
    return complete_records(parsed.withColumn("whole", F.coalesce("whole", typed)))


def complete_records(log: DataFrame) -> DataFrame:
    return log.filter(
        (F.col("page").isNotNull() | F.col("start").isNotNull())
        & F.col("common.mid").isNotNull()
        & F.col("ts").isNotNull()
    )


# --- new-visitor repair -------------------------------------------------------------------------------------------
#
# A device's first visit day is set once, by its first record that says new (1) or old (0): the day of a new visitor,
# the day before for an old one. A later record that says new on another day is wrong and becomes old.
# "First" is by time; of two records of a device with the same millisecond the one that says old counts as first.
# Time and flag of that record fit one number, so finding it is a plain minimum.


def visit_code(ts: Column, is_new: Column) -> Column:
    """Sortable time and flag of a record that can set the first visit; NULL for all others."""
    return F.when(is_new.isin("0", "1"), ts * 2 + (is_new == "1").cast("bigint"))


def first_day(code: Column, zone: str | None = None) -> Column:
    """First visit day that a coded record sets."""
    ts = F.shiftright(code, 1)
    return day_of(ts - F.when(F.pmod(code, F.lit(2)) == 0, F.lit(DAY_MS)).otherwise(F.lit(0)), zone)


def first_visits(log: DataFrame) -> DataFrame:
    """First deciding record per device, the span of its records that say new, and how many records it has."""
    ts, is_new = F.col("ts"), F.col("common.is_new")
    new_ts = F.when(is_new == "1", ts)
    return (
        log.groupBy(F.col("common.mid").alias("mid"))
        .agg(F.min(visit_code(ts, is_new)).alias("code"), F.min(new_ts).alias("new_from"),
             F.max(new_ts).alias("new_to"), F.count("*").alias("n"))
    )


def devices_to_repair(visits: DataFrame, zone: str | None = None) -> DataFrame:
    """Devices with a record that says new on another day than the first."""
    day = first_day(F.col("code"), zone)
    return visits.filter(
        (day_of(F.col("new_from"), zone) != day) | (day_of(F.col("new_to"), zone) != day)
    ).select("mid", day.alias("_first_day"))


def busy_devices(visits: DataFrame, share: float = 0.02, parts: int = 64) -> Salt:
    """Devices with at least `share` of all records: at most 1 / share of them."""
    total = visits.agg(F.sum("n")).first()[0] or 0
    busy = visits.filter(F.col("n") >= max(share * total, 1)).select("mid").collect()
    return Salt(parts, tuple(sorted(r.mid for r in busy))) if busy else NO_SALT


def repaired_flag(first: Column, zone: str | None = None) -> Column:
    """Flag of a record, old if it says new on another day than its device's first; as it is if that is not known."""
    wrong = (F.col("common.is_new") == "1") & (day_of(F.col("ts"), zone) != first)
    return F.when(wrong, F.lit("0")).otherwise(F.col("common.is_new"))


def repair_with(log: DataFrame, devices: DataFrame, zone: str | None = None, salt: Salt = NO_SALT) -> DataFrame:
    """Rewrite the flag of records that say new on another day than their device's first."""
    joined = interval_join(log.withColumn("_mid", F.col("common.mid")), devices, "_mid", "mid", None, "left", salt)
    return joined.withColumn("common", F.col("common").withField("is_new", repaired_flag(F.col("_first_day"), zone))).select(*log.columns)


def repair_from(log: DataFrame, visits: DataFrame, zone: str | None = None) -> DataFrame:
    """Repair with stored first visits.

    Only devices that need it are joined back: by broadcast if they are few, and the log is not shuffled; otherwise by
    shuffle, with the records of busy devices dealt to several tasks.
    """
    devices = devices_to_repair(visits, zone)
    if fits(devices):
        return repair_with(log, F.broadcast(devices), zone)
    return repair_with(log, devices, zone, busy_devices(visits))


def repair_visitors(log: DataFrame, zone: str | None = None) -> DataFrame:
    """New-visitor repair of a batch.

    Finding the first visits is a minimum per device, reduced before the shuffle and written out: one row per device.
    No task sees all records of a device.
    """
    return repair_from(log, materialise(first_visits(log), "visitors"), zone)


# --- split --------------------------------------------------------------------------------------------------------

TOPICS = (S.TRAFFIC_PAGE, S.TRAFFIC_START, S.TRAFFIC_ERR, S.TRAFFIC_DISPLAY, S.TRAFFIC_ACTION)


def errors(log: DataFrame) -> DataFrame:
    """Error objects alone, without their context."""
    return log.filter(F.col("err").isNotNull()).select("err.*")


def starts(log: DataFrame) -> DataFrame:
    """Start records whole, but for the error."""
    return log.filter(F.col("start").isNotNull()).drop("err", "whole")


def _page_records(log: DataFrame) -> DataFrame:
    return log.filter(F.col("start").isNull() & F.col("page").isNotNull())


def pages(log: DataFrame) -> DataFrame:
    """What is left of a page record once errors, displays and actions are taken out."""
    return _page_records(log).drop("err", "start", "displays", "actions", "whole")


def displays(log: DataFrame) -> DataFrame:
    """One row per displayed item, with the page record's context."""
    rows = _page_records(log).select("common", "page", "ts", F.explode("displays").alias("item_"))
    return rows.select("item_.*", "common", "page", "ts")


def actions(log: DataFrame) -> DataFrame:
    """One row per action, with the page record's context; the record's time replaces the action's own."""
    rows = _page_records(log).select("common", "page", "ts", F.explode("actions").alias("item_"))
    return rows.select(
        *[F.col("item_")[f].alias(f) for f in S.ACTION.fieldNames() if f != "ts"], "common", "page", "ts"
    )


def split_messages(log: DataFrame, topics: tuple[str, ...] = TOPICS) -> DataFrame:
    """All five outputs in one pass: topic and JSON text, with every field of the record, known or not.

    Each record becomes the list of its messages, so the log is read once however many topics there are; of topics that are
    not among `topics` no message is built. The context that the items of a record share becomes text once. The flag of new
    visitors is that of the typed column, which a repair may have changed.
    """
    fields = "map<string,variant>"
    none = "cast(array() AS array<struct<topic:string,value:string>>)"

    def message(topic: str, text: str) -> str:
        return f"named_struct('topic', '{topic}', 'value', {text})"

    def spread(array: str, topic: str) -> str:
        """A message per element: its fields, and the record's context in place of its own."""
        if topic not in topics:
            return none
        own = "to_json(map_filter(item, (k, v) -> k NOT IN ('common', 'page', 'ts')))"
        found = f"filter(transform(try_cast(_record['{array}'] AS array<variant>), e -> try_cast(e AS {fields})), item -> item IS NOT NULL)"
        own = f"transform({found}, item -> {own})"
        text = "concat(left(own, length(own) - 1), if(own = '{}', '', ','), substring(_context, 2))"
        return f"coalesce(transform({own}, own -> {message(topic, text)}), {none})"

    def whole(topic: str, *but: str) -> str:
        left_out = ", ".join(f"'{n}'" for n in but)
        return f"array({message(topic, f'to_json(map_filter(_record, (k, v) -> k NOT IN ({left_out})))')})" if topic in topics else none

    error = message(S.TRAFFIC_ERR, "to_json(_record['err'])")
    flag = "if(common.is_new IS NULL, map(), map('is_new', CAST(common.is_new AS variant)))"
    common = f"map_concat(map_filter(CAST(_fields['common'] AS {fields}), (k, v) -> k <> 'is_new'), {flag})"
    record = f"map_concat(map_filter(_fields, (k, v) -> k <> 'common'), map('common', to_variant_object({common})))"
    items = "start IS NULL AND page IS NOT NULL AND (_record['displays'] IS NOT NULL OR _record['actions'] IS NOT NULL)"
    context = "to_json(map('common', _record['common'], 'page', _record['page'], 'ts', _record['ts']))"
    messages = f"""concat(
        {f"if(err IS NOT NULL, array({error}), {none})" if S.TRAFFIC_ERR in topics else none},
        CASE WHEN start IS NOT NULL THEN {whole(S.TRAFFIC_START, "err")}
             WHEN page IS NOT NULL THEN concat(
                {spread("displays", S.TRAFFIC_DISPLAY)}, {spread("actions", S.TRAFFIC_ACTION)},
                {whole(S.TRAFFIC_PAGE, "err", "start", "displays", "actions")})
             ELSE {none} END)"""
    parsed = log.withColumn("_fields", F.expr(f"CAST(whole AS {fields})")).withColumn("_record", F.expr(record))
    return parsed.withColumn("_context", F.expr(f"CASE WHEN {items} THEN {context} END")).select(F.inline(F.expr(messages)))
