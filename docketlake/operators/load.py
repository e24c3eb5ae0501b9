"""Nested digests to the four relational tables with dense surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docketlake.schemas import ENFORCEMENT_TABLES, PRIMARY_KEYS, REQUIRED_COLUMNS

CHILDREN = {
    "respondents": ["name", "entity_type", "location"],
    "violations": ["statute", "description"],
    "sanctions": ["sanction_type", "description", "duration", "amount"],
}
KINDS = ["actions", *CHILDREN]
_ACTION_FIELDS = ["action_type", "title", "settlement", "court", "case_number",
                  "release_number", "full_text"]


# --- selection ---------------------------------------------------------------

def fault(df: DataFrame) -> Column:
    """Why a nested digest cannot be loaded, null when it can."""
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in df.columns else F.lit(False)
    no_type = F.exists("actions", lambda a: a["action_type"].isNull())
    no_name = F.exists("actions", lambda a: F.exists(a["respondents"], lambda r: r["name"].isNull()))
    return (
        F.when(corrupt, "unreadable file")
        .when(F.col("digest_date").isNull(), "no digest date")
        .when(has_actions() & F.coalesce(no_type, F.lit(False)), "action without type")
        .when(has_actions() & F.coalesce(no_name, F.lit(False)), "respondent without name")
    )


def has_actions() -> Column:
    return F.coalesce(F.col("has_enforcement_actions"), F.lit(False)) & (
        F.coalesce(F.size("actions"), F.lit(0)) > 0
    )


def day_bitmaps(dates: DataFrame) -> DataFrame:
    """(year, days): the days of ``digest_date`` as one bitmap per year."""
    day = F.bitmap_bit_position(F.dayofyear("digest_date"))
    return (dates.where(F.col("digest_date").isNotNull()).groupBy(F.year("digest_date").alias("year"))
            .agg(F.bitmap_construct_agg(day).alias("days")))


def joined_days(bitmaps: DataFrame) -> DataFrame:
    """(year, days) of several bitmaps a year."""
    return bitmaps.groupBy("year").agg(F.bitmap_or_agg("days").alias("days"))


def _with_known(digests: DataFrame, days: DataFrame) -> DataFrame:
    """Adds ``_known``: whether the digest's day is set in the bitmap of its year.

    The bitmaps are broadcast, so nested rows are not shuffled: 4 KB a year, and a DATE
    has at most 10,000 years.
    """
    day = F.dayofyear("digest_date") - 1
    byte = F.conv(F.hex(F.substring(F.col("_days"), F.floor(day / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.broadcast(days.select(F.col("year").alias("_year"), F.col("days").alias("_days")))
    return (
        digests.join(known, F.year("digest_date") == F.col("_year"), "left")
        .withColumn("_known", F.coalesce(F.getbit(byte, day % 8) == 1, F.lit(False)))
        .drop("_year", "_days")
    )


def classify(digests: DataFrame, loaded: DataFrame) -> DataFrame:
    """Adds ``load_outcome``: error, skipped_existing, no_actions or loaded; and ``fault``.

    ``loaded`` has the bitmaps of :func:`day_bitmaps`. The skip set is read once, so two
    new digests of the same date both load.
    """
    reason = fault(digests)
    unreadable = reason.isin("unreadable file", "no digest date")
    outcome = (
        F.when(unreadable, "error")
        .when(F.col("_known"), "skipped_existing")
        .when(~has_actions(), "no_actions")
        .when(reason.isNotNull(), "error")
        .otherwise("loaded")
    )
    return (
        _with_known(digests, loaded)
        .withColumn("fault", reason)
        .withColumn("load_outcome", outcome)
        .drop("_known")
    )


def not_loaded(digests: DataFrame, loaded: DataFrame) -> DataFrame:
    """Digests whose date is not set in the bitmaps of the loaded days."""
    return _with_known(digests, loaded).where(~F.col("_known")).drop("_known")


def load_metrics(columns: list[str]) -> list[Column]:
    """The counts of a load run, as aggregates over its classified digests.

    ``failed`` are those of ``no_actions`` whose extraction failed: a record that says it
    has actions and holds none.
    """
    o = F.col("load_outcome")
    n_actions = F.col("n_actions") if "n_actions" in columns else F.size("actions")
    claims = F.coalesce(F.col("has_enforcement_actions"), F.lit(False))
    return [
        F.count_if(o == "loaded").alias("loaded"),
        F.count_if(o == "skipped_existing").alias("skipped_existing"),
        F.count_if(o == "no_actions").alias("no_actions"),
        F.count_if(o == "error").alias("errors"),
        F.coalesce(F.sum(F.when(o == "loaded", n_actions)), F.lit(0)).alias("total_actions"),
        F.count_if((o == "no_actions") & claims).alias("failed"),
    ]


def load_stats(classified: DataFrame) -> DataFrame:
    """One row of counts of a load run, with the digests that share a new date with an earlier one."""
    dates = F.count_distinct(F.when(F.col("load_outcome") == "loaded", F.col("digest_date")))
    return classified.agg(*load_metrics(classified.columns), dates.alias("_dates")).withColumn(
        "repeated_dates", F.col("loaded") - F.col("_dates")).drop("_dates")


def total_metrics() -> list[Column]:
    """How many rows a run adds to each table, from the stored sizes."""
    loaded = F.col("load_outcome") == "loaded"
    return [F.coalesce(F.sum(F.when(loaded, F.col(f"n_{k}"))), F.lit(0)).alias(f"rows_{k}") for k in KINDS]


def repeated_dates(classified: DataFrame) -> DataFrame:
    """Dates that more than one digest of this run loads."""
    return (
        classified.where(F.col("load_outcome") == "loaded")
        .groupBy("digest_date").agg(F.count("*").alias("n")).where("n > 1")
    )


# --- surrogate ids -----------------------------------------------------------

def with_sizes(digests: DataFrame) -> DataFrame:
    """Adds the number of rows that every digest brings to each table."""
    def children(name: str) -> Column:
        return F.aggregate("actions", F.lit(0),
                           lambda n, a: n + F.coalesce(F.size(a[name]), F.lit(0)))

    sizes = {"n_actions": F.size("actions"), **{f"n_{c}": children(c) for c in CHILDREN}}
    return digests.withColumns(sizes)


#: Stored bytes of nested rows that one range holds, and the most ranges.
RANGE_BYTES, MOST_RANGES = 16 << 20, 4096


def _ranges(digests: DataFrame) -> int:
    """Ranges for :func:`with_offsets`: two a core at least, more for more bytes."""
    size = int(digests._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = digests.sparkSession.sparkContext.defaultParallelism
    return min(max(size // RANGE_BYTES, 2 * cores), MOST_RANGES)


def with_offsets(digests: DataFrame, order: list[str]) -> DataFrame:
    """Adds to each digest, per table, the number of rows that all digests before it bring.

    ``order`` must be unique. A prefix sum without a global window or a join back: sizes
    and order alone are dealt over ranges, of which each keeps its lowest key and its
    totals (one row a range). By those keys the digests are dealt to the same ranges, the
    one exchange that moves nested rows, and summed up inside each. There are as many
    ranges as the nested rows need, and a digest's is found by halving.
    """
    sized = digests if f"n_{KINDS[-1]}" in digests.columns else with_sizes(digests)
    counts = [f"n_{k}" for k in KINDS]
    key = F.struct(*order)
    dealt = sized.select(*order, *counts).repartitionByRange(_ranges(sized), *order).withColumn(
        "_part", F.spark_partition_id())
    ranges = dealt.groupBy("_part").agg(F.min(key).alias("_low"), *[F.sum(c).alias(c) for c in counts])
    earlier = Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_low", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in counts])
    rows = F.sort_array(F.collect_list(F.struct("_low", *[f"_{c}" for c in counts])))
    halves = F.transform(F.sequence(F.ceil(F.log2(F.count("*"))).cast("int"), F.lit(0), F.lit(-1)),
                         lambda n: F.pow(F.lit(2), n).cast("int"))
    bounds = starts.agg(F.struct(rows.alias("rows"), halves.alias("halves")).alias("_ranges"))
    at = F.aggregate("_ranges.halves", F.lit(-1), lambda low, half: F.when(
        F.get("_ranges.rows", low + half)["_low"] <= key, low + half).otherwise(low))
    placed = sized.withColumn("_ranges", bounds.scalar()).withColumn("_start", F.get("_ranges.rows", at)).drop("_ranges")
    inside = Window.partitionBy("_start").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumns({
        f"{k}_offset": F.coalesce(F.sum(f"n_{k}").over(inside), F.lit(0)) + F.col(f"_start._n_{k}") for k in KINDS
    }).drop("_start")


def next_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the next free id of every table, 1 for an empty one."""
    rows = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("t"), "id")
        rows = one if rows is None else rows.unionAll(one)
    return rows.agg(*[
        (F.coalesce(F.max(F.when(F.col("t") == n, F.col("id"))), F.lit(0)) + 1).alias(n)
        for n in tables
    ])


# --- flattening --------------------------------------------------------------

def flatten_actions(digests: DataFrame, start: Column | int | None = None) -> DataFrame:
    """One row per action with the digest's date and notes.

    With ``start`` (the first free id) and the offsets of :func:`with_offsets`
    the rows also get their id.
    """
    keep = [c for c in digests.columns if c not in ("actions", "has_enforcement_actions")]
    # Only the action's own fields leave the array, so child lists are not copied.
    slim = F.transform("actions", lambda a, i: F.struct(
        i.alias("pos"), *[a[f].alias(f) for f in _ACTION_FIELDS]))
    rows = digests.select(*keep, F.explode(slim).alias("_a"))
    ids = [] if start is None else [(F.col("actions_offset") + F.col("_a.pos") + start).alias("id")]
    keep = [c for c in keep if not c.endswith("_offset")]
    return rows.select(*ids, *keep, "_a.*")


def flatten_children(digests: DataFrame, kind: str, action_start: Column | int | None = None,
                     start: Column | int | None = None) -> DataFrame:
    """One row per respondent, violation or sanction, in document order.

    ``action_pos`` and ``pos`` place it; ids are added when the first free ids of
    both tables are given. An empty list gives no rows.
    """
    fields = CHILDREN[kind]
    items = F.flatten(F.transform("actions", lambda a, i: F.transform(
        a[kind], lambda c, j: F.struct(i.alias("action_pos"), j.alias("pos"), c.alias("item")))))
    keep = [c for c in digests.columns
            if c not in ("actions", "has_enforcement_actions", "extraction_notes")]
    rows = digests.select(*keep, F.posexplode(items).alias("_n", "_x"))
    ids = []
    if start is not None:
        ids = [
            (F.col(f"{kind}_offset") + F.col("_n") + start).alias("id"),
            (F.col("actions_offset") + F.col("_x.action_pos") + action_start).alias("action_id"),
        ]
    keep = [c for c in keep if not c.endswith("_offset")]
    return rows.select(*ids, *keep, "_x.action_pos", "_x.pos",
                       *[F.col(f"_x.item.{f}").alias(f) for f in fields])


def action_profile(digests: DataFrame) -> DataFrame:
    """Number of respondents, violations and sanctions of every action."""
    keep = [c for c in digests.columns
            if c not in ("actions", "has_enforcement_actions", "extraction_notes")]
    counts = F.transform("actions", lambda a, i: F.struct(i.alias("pos"), *[
        F.coalesce(F.size(a[k]), F.lit(0)).alias(f"n_{k}") for k in CHILDREN]))
    return digests.select(*keep, F.explode(counts).alias("_a")).select(*keep, "_a.*")


# --- integrity ---------------------------------------------------------------

def orphans(children: dict[str, DataFrame], actions: DataFrame) -> DataFrame:
    """Per child table, the number of rows whose action does not exist.

    Children and actions meet in one aggregate by action, without a join: no set of all
    keys is broadcast, and one action with very many children is a few rows in the
    shuffle.
    """
    rows = actions.where(F.col("id").isNotNull()).select(F.col("id").alias("action_id"), F.lit(-1).alias("_table"))
    for number, df in enumerate(children.values()):
        rows = rows.unionAll(df.select("action_id", F.lit(number).alias("_table")))
    counts = {name: f"_n{number}" for number, name in enumerate(children)}
    missing = rows.groupBy("action_id").agg(
        F.count_if(F.col("_table") == -1).alias("_known"),
        *[F.count_if(F.col("_table") == number).alias(n) for number, n in enumerate(counts.values())],
    ).where("_known = 0").agg(*[F.sum(n).alias(n) for n in counts.values()])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("table"), F.col(n).alias("n")) for name, n in counts.items()]))
    return missing.select(each.alias("_each")).select("_each.*").where("n > 0")


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table, the number of keys that are not unique and of nulls where none may be."""
    result = None
    for name, df in tables.items():
        key = PRIMARY_KEYS[name]
        nulls = F.lit(False)
        for c in [key, *REQUIRED_COLUMNS.get(name, [])]:
            if c in df.columns:
                nulls = nulls | F.col(c).isNull()
        one = df.groupBy(key).agg(F.count("*").alias("c"), F.count_if(nulls).alias("bad")).agg(
            F.count_if((F.col("c") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("null_rows"),
        ).select(F.lit(name).alias("table"), "repeated_keys", "null_rows")
        result = one if result is None else result.unionAll(one)
    return result


def integrity_metrics(table: str, columns: list[str], first: int, action_ids: tuple[int, int]) -> list[Column]:
    """Metrics over one table of a load: how its ids fill an interval, nulls, children of no action.

    Ids are taken from ``first`` on, as whole numbers that sums of squares don't overflow.
    """
    place = (F.col("id") - first).cast("decimal(19,0)")
    nulls = F.lit(False)
    for c in [PRIMARY_KEYS[table], *REQUIRED_COLUMNS[table]]:
        if c in columns:
            nulls = nulls | F.col(c).isNull()
    none = F.lit(0)
    astray = ~F.col("action_id").between(*action_ids) if "action_id" in columns else F.lit(False)
    return [
        F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"),
        F.coalesce(F.sum(place), none).alias("places"), F.coalesce(F.sum(place * place), none).alias("squares"),
        F.count_if(nulls).alias("nulls"), F.count_if(astray).alias("orphans"),
    ]


def integrity_faults(table: str, seen: dict, rows: int) -> list[str]:
    """What the metrics of a table have against it.

    Ids that repeat would change the range, the sum or the sum of squares of the places.
    """
    last = rows - 1
    dense = seen["n"] == 0 or (
        seen["low"] == 0 and seen["high"] == last and seen["places"] == last * rows // 2
        and seen["squares"] == last * rows * (2 * last + 1) // 6)
    found = {f"{seen['n']} rows in place of {rows}": seen["n"] != rows, "ids that repeat or leave gaps": not dense,
             f"{seen['nulls']} rows with nulls": seen["nulls"] > 0, f"{seen['orphans']} rows of no action": seen["orphans"] > 0}
    return [f"{table}: {what}" for what, holds in found.items() if holds]


# --- assembly ----------------------------------------------------------------

#: Children of one kind that a page holds at most.
PAGE = 100


def child_pages(children: DataFrame, kind: str, page: int = PAGE, block: int = 1 << 14) -> DataFrame:
    """(id, page, kind): the children of every action by id and fields, at most ``page`` to a row.

    Children are ranked within (action, range of ``block`` ids) and the ranges counted
    first, so an action that has a third of all children is many small groups.
    """
    keys = ["action_id", "_block"]
    blocked = children.select("action_id", "id", *CHILDREN[kind]).withColumn("_block", F.floor(F.col("id") / block))
    before = Window.partitionBy("action_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocked.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("id", *CHILDREN[kind])) - 1
    ranked = blocked.withColumn("_rank", rank).join(starts, keys)
    number = F.floor((F.col("_before") + F.col("_rank")) / page)
    return ranked.groupBy(F.col("action_id").alias("id"), number.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("id", *CHILDREN[kind]))).alias(kind))   # ``page`` at most


def assemble_actions(actions: DataFrame, children: dict[str, DataFrame], page: int = PAGE) -> DataFrame:
    """Every action with all its fields and children, in pages: the nested form again.

    One row per action and page, from page 0 on; the lists of a page hold at most ``page``
    children each, by id, as structs of id and fields. Actions without children have an
    empty page 0; children of no action are left out.
    """
    pages = None
    for kind in CHILDREN:
        one = child_pages(children[kind], kind, page)
        pages = one if pages is None else pages.join(one, ["id", "page"], "full")
    pages = pages.withColumnRenamed("id", "_id").withColumnRenamed("page", "_page")
    joined = actions.join(pages, F.col("id") == F.col("_id"), "left")
    return joined.select(
        *actions.columns, F.coalesce("_page", F.lit(0)).cast("bigint").alias("page"),
        *[F.coalesce(k, F.array().cast(pages.schema[k].dataType)).alias(k) for k in CHILDREN])


def action_overview(actions: DataFrame, respondents: DataFrame, violations: DataFrame,
                    sanctions: DataFrame) -> DataFrame:
    """Every action with the number of its children and its first respondent.

    The children are reduced to one row per action before the join.
    """
    n_resp = respondents.groupBy("action_id").agg(
        F.count("*").alias("n_resp"), F.min_by("name", "id").alias("first_name"))
    n_viol = violations.groupBy("action_id").agg(F.count("*").alias("n_viol"))
    n_sanc = sanctions.groupBy("action_id").agg(F.count("*").alias("n_sanc"))
    out = actions.select(F.col("id"))
    for side in (n_resp, n_viol, n_sanc):
        side = side.withColumnRenamed("action_id", "id")
        out = out.join(side, "id", "left")
    zero = {"n_resp": 0, "n_viol": 0, "n_sanc": 0}
    return out.fillna(zero).select("id", "n_resp", "n_viol", "n_sanc", "first_name")


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame([], s) for n, s in ENFORCEMENT_TABLES.items()}
