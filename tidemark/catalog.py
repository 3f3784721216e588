"""The registered queries of the engine and their SQL. Every query works on its whole tables. Where a
merge needs rows that are stored and rows that are delivered, both are the whole table, the stored ones under twice the key
and the delivered ones under three times the key: keys divisible by six meet, the others are untouched or new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import partitions, types
from .operators import changes, incremental, merge, scd2, shred
from .operators.merge import MergeSpec
from .operators.survivors import flagged, survivors
from .plans import commit
from .plans.options import TableOptions
from .session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return add


# Inputs: event_id is the order of arrival.
E = "event_id, ts, user_id, event_type, value"
STAGE = "(SELECT event_id, ts, user_id * 3 AS user_id, event_type, value FROM events)"
LAST = lambda src, order="event_id DESC", key="user_id": f"(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1)"
TARGET = LAST("(SELECT event_id, ts, user_id * 2 AS user_id, event_type, value FROM events)")
ROW = ["event_id", "ts", "user_id", "event_type", "value"]


def events(s, d):
    return table(s, d, "events").select(*ROW)


def stage(s, d):
    return events(s, d).withColumn("user_id", F.col("user_id") * 3)


def target(s, d):
    return survivors(events(s, d).withColumn("user_id", F.col("user_id") * 2), ["user_id"], "event_id")


USER = MergeSpec(("user_id",), "event_id")


# Survivors
@query(f"SELECT * FROM {LAST(STAGE)}")
def dedup_last_wins(s, d):
    return survivors(stage(s, d), ["user_id"], "event_id")


SOME_NULL = f"(SELECT {E}, CASE WHEN event_id % 11 <> 0 THEN value END AS v FROM events)"
for _way in ("desc", "asc"):

    @query(f"SELECT * FROM {LAST(SOME_NULL, f'v {_way} NULLS LAST, event_id DESC')}", f"dedup_sort_{_way}")
    def _dedup(s, d, way=_way):
        return survivors(events(s, d).withColumn("v", F.expr("CASE WHEN event_id % 11 <> 0 THEN value END")), ["user_id"], "event_id", ("v", way))


ALL_NULL = f"(SELECT {E}, CASE WHEN user_id % 3 <> 0 THEN value END AS v FROM events)"


@query(f"SELECT * FROM {LAST(ALL_NULL, 'v DESC NULLS LAST, event_id DESC')}")
def dedup_all_null(s, d):
    return survivors(events(s, d).withColumn("v", F.expr("CASE WHEN user_id % 3 <> 0 THEN value END")), ["user_id"], "event_id", ("v", "desc"))


@query(f"SELECT {E} FROM events WHERE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type = 'click' END) IS NOT TRUE")
def hard_delete_bool(s, d):
    df = events(s, d).withColumn("gone", F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type = 'click' END"))
    return df.filter(~flagged(df, "gone")).drop("gone")


@query(f"SELECT {E} FROM events WHERE CASE WHEN event_type = 'click' THEN 'x' END IS NULL")
def hard_delete_nonbool(s, d):
    df = events(s, d).withColumn("gone", F.expr("CASE WHEN event_type = 'click' THEN 'x' END"))
    return df.filter(~flagged(df, "gone")).drop("gone")


# Merge arms
UNTOUCHED = f"SELECT {E} FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {STAGE})"


@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE)}")
def merge_delete_insert(s, d):
    return merge.delete_insert(target(s, d), stage(s, d), USER)


@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE)} WHERE event_type <> 'click'")
def merge_delete_insert_hard_delete(s, d):
    rows = stage(s, d).withColumn("gone", F.col("event_type") == "click")
    return merge.delete_insert(target(s, d), rows, MergeSpec(("user_id",), "event_id", hard_delete="gone"))


@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE, 'value DESC NULLS LAST, event_id DESC')}")
def merge_delete_insert_sorted(s, d):
    return merge.delete_insert(target(s, d), stage(s, d), MergeSpec(("user_id",), "event_id", sort=("value", "desc")))


O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
O_OLD = f"(SELECT o_orderkey * 2 AS {O} FROM orders)"
O_NEW = "(SELECT o_orderkey * 3 AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'X' END AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders)"
O_KEPT = f"SELECT {O} FROM {O_OLD} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {O_NEW})"
ORDER = MergeSpec(("o_orderkey",), "o_orderkey")


def old_orders(s, d):
    return table(s, d, "orders").selectExpr(*f"o_orderkey * 2 AS {O}".split(", "))


def new_orders(s, d):
    return table(s, d, "orders").selectExpr("o_orderkey * 3 AS o_orderkey", "o_custkey", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'X' END AS o_orderstatus", "o_totalprice + 1 AS o_totalprice", "o_orderdate")


@query(f"{O_KEPT} UNION ALL SELECT {O} FROM {O_NEW}")
def merge_upsert(s, d):
    return merge.upsert(old_orders(s, d), new_orders(s, d), ORDER)


@query(f"{O_KEPT} UNION ALL SELECT {O} FROM {O_NEW} WHERE o_orderstatus IS NULL")
def merge_upsert_hard_delete(s, d):
    return merge.upsert(old_orders(s, d), new_orders(s, d), MergeSpec(("o_orderkey",), "o_orderkey", hard_delete="o_orderstatus"))


@query("SELECT o_orderkey * 2 AS o_orderkey, 'x' AS mark FROM orders UNION SELECT o_orderkey * 3, 'x' FROM orders")
def merge_upsert_all_key(s, d):
    two = ["o_orderkey", F.lit("x").alias("mark")]
    rows = new_orders(s, d).select(*two).withColumn("n", F.lit(1))
    return merge.upsert(old_orders(s, d).select(*two), rows, MergeSpec(("o_orderkey", "mark"), "n"))


L = "l_orderkey, l_linenumber, scope, l_quantity"
L_ALL = "(SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS scope, l_quantity FROM lineitem)"
L_NEW = f"(SELECT l_orderkey * 3 AS l_orderkey, l_linenumber, scope, l_quantity FROM {L_ALL} WHERE scope IS DISTINCT FROM 'N')"


def lines(s, d):
    return table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS scope", "l_quantity")


def new_lines(s, d):
    return lines(s, d).filter("NOT scope <=> 'N'").withColumn("l_orderkey", F.col("l_orderkey") * 3)


@query(f"SELECT {L} FROM {L_ALL} WHERE scope IS NULL OR scope NOT IN (SELECT scope FROM {L_NEW} WHERE scope IS NOT NULL)")
def merge_scope_null_scope(s, d):
    return merge.scope_replace(lines(s, d), new_lines(s, d), ["scope"])


@query(f"""
WITH kept AS (SELECT {L} FROM {L_ALL} WHERE scope IS NULL OR scope NOT IN (SELECT scope FROM {L_NEW} WHERE scope IS NOT NULL)),
n AS (SELECT {L} FROM {LAST(L_NEW, "l_quantity DESC NULLS LAST, ascii(coalesce(scope, '~')) DESC", 'l_orderkey, l_linenumber')})
SELECT {L} FROM kept WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM {L_NEW}) UNION ALL SELECT {L} FROM n""")
def merge_scope_replace(s, d):
    rows = new_lines(s, d).withColumn("arrival", F.ascii(F.coalesce("scope", F.lit("~"))))
    return merge.delete_insert(lines(s, d), rows, MergeSpec(("l_orderkey", "l_linenumber"), "arrival", sort=("l_quantity", "desc"), scope=("scope",)))


R_NEW = "(SELECT o_orderkey * 3 AS o_orderkey, o_orderstatus, o_orderstatus = 'F' AS gone FROM orders)"


@query(f"SELECT o_orderkey * 2 AS o_orderkey, o_orderstatus FROM orders WHERE o_orderkey * 2 NOT IN (SELECT o_orderkey FROM {R_NEW}) UNION ALL SELECT o_orderkey, o_orderstatus FROM {R_NEW} WHERE gone IS NOT TRUE")
def merge_identity_root(s, d):
    two = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    under = lambda times: two.withColumn("o_orderkey", F.col("o_orderkey") * times)
    rows = under(3).withColumn("gone", F.col("o_orderstatus") == "F")
    return merge.merge_root(under(2), rows, "o_orderkey", "o_orderkey", "gone")


CHILD = "l_orderkey * {k} * 10 + l_linenumber AS id, l_orderkey * {k} AS l_orderkey, l_quantity"


def children(s, d, flag):
    under = lambda times: table(s, d, "lineitem").selectExpr(*CHILD.format(k=times).split(", "))
    roots = table(s, d, "orders").selectExpr("o_orderkey * 3 AS o_orderkey", "o_orderstatus = 'F' AS gone")
    new = under(3).withColumn("l_quantity", F.col("l_quantity") + 1)
    return merge.merge_children(under(2), new, roots, "id", "l_orderkey", "l_quantity", "o_orderkey", "o_orderkey", flag)


_OLD_CHILD = f"SELECT {CHILD.format(k=2)} FROM lineitem WHERE l_orderkey * 2 NOT IN (SELECT o_orderkey FROM {R_NEW})"
_NEW_CHILD = f"SELECT id, l_orderkey, l_quantity + 1 AS l_quantity FROM {LAST(f'(SELECT {CHILD.format(k=3)} FROM lineitem)', 'l_quantity DESC', 'id')}"


@query(f"{_OLD_CHILD} UNION ALL {_NEW_CHILD}")
def merge_identity_children(s, d):
    return children(s, d, None)


@query(f"{_OLD_CHILD} UNION ALL {_NEW_CHILD} WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {R_NEW} WHERE gone)")
def merge_children_flagged_roots(s, d):
    return children(s, d, "gone")


# History
B0, B1, B2, OPEN = "2024-01-01 00:00:00", "2024-06-01 00:00:00", "2024-09-01 00:00:00", "2200-01-01 00:00:00"
C = "c_custkey, c_mktsegment, c_acctbal"
C1 = f"(SELECT {C} FROM customer)"
# The second round lacks a segment, changes values, sets nulls, and has some customers under new keys.
MOVED = "CASE WHEN c_custkey % 10 < 2 THEN -c_custkey ELSE c_custkey END AS c_custkey"
NULLED = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment"
C_NULL = f"(SELECT c_custkey, {NULLED}, c_acctbal FROM customer)"
C2 = f"(SELECT {MOVED}, {NULLED}, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING')"


def customers(s, d):
    return table(s, d, "customer").selectExpr(*C.split(", "))


def round_one(s, d, marker=None):
    return scd2.first_history(customers(s, d), ["c_custkey"], "c_custkey", B0, marker=marker)


def round_two(s, d):
    return table(s, d, "customer").filter("c_mktsegment <> 'BUILDING'").selectExpr(MOVED, NULLED, "CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal")


def history_sql(retire: str | None = None, marker: str | None = None, stage_sql: str = C2) -> str:
    """retire: a condition on h under which versions that weren't delivered close."""
    opened = f"TIMESTAMP '{marker}'" if marker else "CAST(NULL AS TIMESTAMP)"
    differs = "h.c_mktsegment IS DISTINCT FROM n.c_mktsegment OR h.c_acctbal IS DISTINCT FROM n.c_acctbal"
    lost = f"OR (n.c_custkey IS NULL AND {retire})" if retire else ""
    return f"""
WITH h AS (SELECT {C} FROM {C1}), n AS (SELECT {C} FROM {stage_sql})
SELECT h.c_custkey, h.c_mktsegment, h.c_acctbal, TIMESTAMP '{B0}' AS _valid_from,
       CASE WHEN (n.c_custkey IS NOT NULL AND ({differs})) {lost} THEN TIMESTAMP '{B1}' ELSE {opened} END AS _valid_to
FROM h LEFT JOIN n ON h.c_custkey = n.c_custkey
UNION ALL
SELECT n.c_custkey, n.c_mktsegment, n.c_acctbal, TIMESTAMP '{B1}', {opened}
FROM n LEFT JOIN h ON h.c_custkey = n.c_custkey WHERE h.c_custkey IS NULL OR {differs}"""


@query(f"SELECT {C}, TIMESTAMP '{B0}' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to FROM {C1}")
def scd2_first_load(s, d):
    return round_one(s, d)


@query(history_sql())
def scd2_change(s, d):
    return scd2.scd2_merge(round_one(s, d), round_two(s, d), ["c_custkey"], "c_custkey", B1)


@query(history_sql(stage_sql=C_NULL))
def scd2_null_safe_change(s, d):
    """Values become null; the same rows once more change nothing."""
    rows = table(s, d, "customer").selectExpr("c_custkey", NULLED, "c_acctbal")
    once = scd2.scd2_merge(round_one(s, d), rows, ["c_custkey"], "c_custkey", B1)
    return scd2.scd2_merge(once, rows, ["c_custkey"], "c_custkey", B2)


@query(f"SELECT {C}, TIMESTAMP '{B0}' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to FROM {C1}")
def scd2_unchanged_no_churn(s, d):
    return scd2.scd2_merge(round_one(s, d), customers(s, d), ["c_custkey"], "c_custkey", B1)


@query(history_sql("true"))
def scd2_absent_retire(s, d):
    return scd2.scd2_merge(round_one(s, d), round_two(s, d), ["c_custkey"], "c_custkey", B1, absent="retire")


@query(history_sql(f"h.c_mktsegment IN (SELECT c_mktsegment FROM {C2} WHERE c_mktsegment IS NOT NULL)"))
def scd2_scoped_retire(s, d):
    return scd2.scd2_merge(round_one(s, d), round_two(s, d), ["c_custkey"], "c_custkey", B1, absent="retire", scope=["c_mktsegment"])


@query(history_sql(None, OPEN))
def scd2_marker(s, d):
    return scd2.scd2_merge(round_one(s, d, OPEN), round_two(s, d), ["c_custkey"], "c_custkey", B1, marker=OPEN)


@query(f"SELECT _valid_from, count(*) AS n FROM ({history_sql()}) GROUP BY 1")
def scd2_boundary(s, d):
    return scd2_change(s, d).groupBy("_valid_from").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT * FROM ({history_sql()}) WHERE _valid_from <= TIMESTAMP '2024-07-01' AND coalesce(_valid_to, TIMESTAMP '9999-12-31') > TIMESTAMP '2024-07-01'")
def scd2_as_of(s, d):
    return scd2.as_of(scd2_change(s, d), "2024-07-01 00:00:00")


@query(f"SELECT c_custkey, TIMESTAMP '{B1}' AS _valid_from FROM customer WHERE c_custkey % 4 = 0")
def scd2_overlap_check(s, d):
    """A sound history of three rounds has no overlap; second versions that begin before the first ones end are found."""
    sound = scd2.scd2_merge(scd2_change(s, d), customers(s, d), ["c_custkey"], "c_custkey", B2)
    first = round_one(s, d)
    late = first.filter("c_custkey % 4 = 0").withColumn("_valid_from", F.lit(B1).cast("timestamp_ntz")).withColumn("_valid_to", F.lit(None).cast("timestamp_ntz"))
    ended = first.withColumn("_valid_to", F.when(F.col("c_custkey") % 2 == 0, F.lit(B2).cast("timestamp_ntz")))
    bad = scd2.overlaps(sound, ["c_custkey"]).unionByName(scd2.overlaps(ended.unionByName(late), ["c_custkey"]))
    return bad.select("c_custkey", "_valid_from")


# Windows of incremental reads
W = "2024-01-10 00:00:00"
for _name, _sql, _w in [
    ("window_max_closed", f"ts >= TIMESTAMP '{W}'", incremental.Window("ts", "max", W, True)),
    ("window_max_open", f"ts > TIMESTAMP '{W}'", incremental.Window("ts", "max", W, False)),
    ("window_min_closed", f"ts <= TIMESTAMP '{W}'", incremental.Window("ts", "min", W, True)),
    ("window_min_open", f"ts < TIMESTAMP '{W}'", incremental.Window("ts", "min", W, False)),
    ("window_end_inclusive", "event_id >= 100 AND event_id <= 700", incremental.Window("event_id", "max", 100, True, 700, True)),
    ("window_end_exclusive", "event_id >= 100 AND event_id < 700", incremental.Window("event_id", "max", 100, True, 700, False)),
    ("window_min_end", "event_id <= 700 AND event_id > 100", incremental.Window("event_id", "min", 700, True, 100, False)),
    ("window_lag", f"ts >= TIMESTAMP '{W}' - INTERVAL 2 DAY", incremental.Window("ts", "max", W, False, lag="2 days")),
    ("window_lag_integer", "event_id >= 500 - 25", incremental.Window("event_id", "max", 500, False, lag=25)),
]:

    @query(f"SELECT {E} FROM events WHERE {_sql}", _name)
    def _window(s, d, w=_w):
        return incremental.window(events(s, d), w)


for _nulls, _sql in (("include", "v >= 500 OR v IS NULL"), ("exclude", "v >= 500")):

    @query(f"SELECT * FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN event_id END AS v FROM events) WHERE {_sql}", f"window_nulls_{_nulls}")
    def _window_nulls(s, d, nulls=_nulls):
        df = events(s, d).selectExpr("event_id", "CASE WHEN event_id % 9 <> 0 THEN event_id END AS v")
        return incremental.window(df, incremental.Window("v", "max", 500, nulls=nulls))


DAY = "(SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events)"
# An earlier run has read the clicks of the last day.
TOP = f"(SELECT max(day) FROM {DAY})"


def days(s, d):
    return events(s, d).selectExpr("event_id", "user_id", "CAST(ts AS DATE) AS day")


def clicks(s, d, day):
    return events(s, d).filter("event_type = 'click'").selectExpr("event_id", "user_id", "CAST(ts AS DATE) AS day").filter(F.col("day") == F.lit(day))


@query(f"SELECT * FROM {DAY} WHERE day > DATE '2024-01-10' OR (day = DATE '2024-01-10' AND event_id > 300)")
def keyset_resume(s, d):
    return incremental.keyset_resume(days(s, d), "day", "event_id", "2024-01-10", 300)


# Types
CELLS = "CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS {t}) END AS a, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS {t}) || '.5' ELSE CAST(event_id AS {t}) END AS b, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS c, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE '1' END AS d, event_type AS e, CAST(NULL AS {t}) AS f"
_SHAPE = "CASE WHEN bool_or(k = 'text') OR (bool_or(k = 'bool') AND bool_or(k IN ('int', 'float'))) THEN 'text' WHEN bool_or(k = 'bool') THEN 'bool' WHEN bool_or(k = 'float') THEN 'float' WHEN bool_or(k = 'int') THEN 'int' ELSE 'text' END"
_KIND = "CASE WHEN {c} IS NULL OR {c} = '' THEN NULL WHEN {c} IN ('true', 'false') THEN 'bool' WHEN regexp_full_match({c}, '[+-]?\\d+') THEN 'int' WHEN regexp_full_match({c}, '[+-]?\\d+\\.\\d+') THEN 'float' ELSE 'text' END"


@query("SELECT " + ", ".join(f"{_SHAPE.replace('k ', _KIND.format(c=c) + ' ')} AS {c}" for c in "abcdef") + f" FROM (SELECT {CELLS.format(t='VARCHAR')} FROM events)")
def csv_shape_join(s, d):
    return types.survey(events(s, d).selectExpr(*CELLS.format(t="STRING").replace("END AS", "END  AS").split(", ")))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders")
def type_hint_casts(s, d):
    text = table(s, d, "orders").selectExpr("o_orderkey", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price")
    return types.apply_hints(text, {"price": "decimal(14,2)"}).withColumn("price", F.col("price").cast("string"))


@query("SELECT o_orderkey, regexp_full_match(t, '.*\\.\\d*[1-9]\\d?') AND NOT regexp_full_match(t, '.*\\.\\d0') AS refused FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t FROM orders)")
def strict_decimal_refusals(s, d):
    text = table(s, d, "orders").selectExpr("o_orderkey", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS t")
    return text.select("o_orderkey", types.loses_digits(F.col("t"), 14, 1).alias("refused"))


# Sinks
@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '__null__' WHEN c_custkey % 7 = 1 THEN '__empty__' WHEN c_custkey % 7 = 2 THEN replace(c_mktsegment, ' ', '%20') || '%2F%C3%A9' ELSE c_mktsegment END AS part FROM customer")
def partition_encode(s, d):
    value = F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '' WHEN c_custkey % 7 = 2 THEN c_mktsegment || '/é' ELSE c_mktsegment END")
    return table(s, d, "customer").select("c_custkey", partitions.encode_partition(value).alias("part"))


@query("SELECT CASE WHEN l_orderkey % 6 = 0 THEN '__null__' ELSE l_returnflag END AS part, count(*) AS n FROM lineitem GROUP BY 1")
def partition_counts(s, d):
    value = F.expr("CASE WHEN l_orderkey % 6 <> 0 THEN l_returnflag END")
    return table(s, d, "lineitem").groupBy(partitions.encode_partition(value).alias("part")).agg(F.count(F.lit(1)).alias("n"))


for _unit in ("year", "month", "day", "hour"):

    @query(f"SELECT event_id, CAST(date_trunc('{_unit}', ts) AS TIMESTAMP) AS part FROM events", f"transform_{_unit}")
    def _transform(s, d, unit=_unit):
        return events(s, d).select("event_id", partitions.transform(unit, "ts").cast("timestamp_ntz").alias("part"))


@query("SELECT event_id, substr(event_type, 1, 3) AS part, event_id - event_id % 16 AS number FROM events")
def transform_truncate(s, d):
    return events(s, d).select("event_id", partitions.transform("truncate", "event_type", 3, text=True).alias("part"), partitions.transform("truncate", "event_id", 16).alias("number"))


@query("SELECT event_id, CAST(event_type AS VARCHAR) AS event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS BIGINT) AS added FROM events")
def align_to_schema(s, d):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("user_id", T.StringType()), T.StructField("added", T.LongType())])
    return types.align(events(s, d).drop("ts", "value"), schema)


@query("SELECT event_id, CAST(NULL AS BIGINT) AS load, 'a' AS unit FROM events UNION ALL SELECT event_id, NULL, 'b' FROM events")
def append_units(s, d):
    rows = events(s, d).select("event_id", F.lit(None).cast("long").alias("load"))
    t, out = commit.Table("t", "append"), rows.limit(0).withColumn("unit", F.lit(""))
    for seq, unit in enumerate("ab"):
        new = rows.withColumn("unit", F.lit(unit))
        out = commit.run_commit(commit.plan_commit([t], commit.Facts("l", seq)), [t], lambda _, now=out: now, lambda _, new=new: new, "event_id")["t"]
    return out


@query("SELECT event_id * 2 AS event_id FROM events UNION ALL SELECT event_id * 3 FROM events")
def replace_once_per_load(s, d):
    rows = events(s, d).select("event_id")
    t, out, cleared = commit.Table("t", "replace"), rows, frozenset()
    for seq in range(2):
        new = rows.select((F.col("event_id") * (seq + 2)).alias("event_id"))
        out = commit.run_commit(commit.plan_commit([t], commit.Facts("l", seq, cleared=cleared)), [t], lambda _, now=out: now, lambda _, new=new: new, "event_id")["t"]
        cleared = frozenset({"t"})
    return out


@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE)}")
def commit_merge(s, d):
    t = commit.Table("t", "merge", ("user_id",), TableOptions(strategy="upsert"))
    steps = commit.plan_commit([t], commit.Facts("l", 0))
    return commit.run_commit(steps, [t], lambda _: target(s, d), lambda _: stage(s, d), "event_id")["t"]


# Nested records
def nested(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.struct("o_orderstatus", F.struct(F.col("o_custkey").alias("key")).alias("customer")).alias("info"))
    items = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("items"))
    return o.join(items, o["o_orderkey"] == items["l_orderkey"], "left").drop("l_orderkey")


@query("SELECT o_orderkey, o_orderstatus AS info__o_orderstatus, o_custkey AS info__customer__key FROM orders")
def shred_flatten(s, d):
    return shred.shred(nested(s, d), "orders", ["o_orderkey"])["orders"].drop("_sys_id")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS _sys_pos, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def shred_children(s, d):
    parts = shred.shred(nested(s, d), "orders", ["o_orderkey"])
    roots = parts["orders"].select(F.col("_sys_id").alias("_sys_root_id"), "o_orderkey")
    return parts["orders__items"].join(roots, "_sys_root_id").select("o_orderkey", F.col("_sys_pos").cast("long").alias("_sys_pos"), "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_custkey, c_name AS _parent_c_name, c_mktsegment AS _parent_c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def parent_include(s, d):
    return shred.include_parent(table(s, d, "orders").select("o_orderkey", "o_custkey"), table(s, d, "customer"), ["o_custkey"], ["c_custkey"], ["c_name", "c_mktsegment"])


@query("SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey >= 100 GROUP BY 1")
def query_stream(s, d):
    from .sources.query import query_stream as stream

    sql = "SELECT o.o_orderkey, c.c_mktsegment, o.o_totalprice FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"
    rows = incremental.window(stream(s, sql, {n: table(s, d, n) for n in ("orders", "customer")}), incremental.Window("o_orderkey", "max", 100))
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# Changes: transactions of ten events; the last one stays open.
_OP = "CASE event_id % 6 WHEN 0 THEN 'D' WHEN 1 THEN 'K' ELSE 'U' END"
_LOG = f"(SELECT event_id // 10 AS lsn, event_id % 10 AS seq, {_OP} AS op, user_id, event_type, value FROM events WHERE event_id // 10 < (SELECT max(event_id // 10) FROM events))"
_APPLIED = f"""(SELECT lsn, seq * 2 AS seq, user_id, CASE WHEN op = 'U' THEN event_type END AS event_type, CASE WHEN op = 'U' THEN value END AS value, CASE WHEN op <> 'U' THEN true END AS _deleted FROM {_LOG}
UNION ALL SELECT lsn, seq * 2 + 1, user_id + 100000, event_type, value, NULL FROM {_LOG} WHERE op = 'K')"""


def change_log(s, d):
    row = lambda key: f"named_struct('user_id', {key}, 'event_type', event_type, 'value', value)"
    log = table(s, d, "events").selectExpr("event_id div 10 AS txn", "event_id % 10 AS seq", "CASE event_id % 6 WHEN 0 THEN 'D' ELSE 'U' END AS op", f"{row('user_id')} AS before", f"IF(event_id % 6 = 0, NULL, {row('IF(event_id % 6 = 1, user_id + 100000, user_id)')}) AS after")
    last = log.agg(F.max("txn").alias("last"))
    commits = log.select("txn").distinct().join(F.broadcast(last)).filter("txn < last").select("txn", F.col("txn").alias("lsn"))
    return log, commits


def applied(s, d, since=None):
    log, commits = change_log(s, d)
    return changes.apply_changes(changes.committed(log, commits, since), ["user_id"])


@query(f"SELECT * FROM {_APPLIED}")
def cdc_apply(s, d):
    return applied(s, d)


@query(f"SELECT * FROM {_APPLIED} WHERE user_id >= 100000 OR _deleted")
def cdc_key_change(s, d):
    return applied(s, d).filter("user_id >= 100000 OR _deleted")


@query(f"SELECT * FROM {_APPLIED} WHERE lsn > 20")
def cdc_skip_applied(s, d):
    return applied(s, d, since=20)


@query(f"SELECT max(lsn) AS last, count(DISTINCT lsn) AS units FROM {_APPLIED}")
def cdc_open_txn_dropped(s, d):
    return applied(s, d).agg(F.max("lsn").alias("last"), F.countDistinct("lsn").alias("units"))


_LAST_CHANGE = LAST(_APPLIED, "lsn DESC, seq DESC")


@query(f"SELECT user_id, event_type, value FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {_APPLIED}) UNION ALL SELECT user_id, event_type, value FROM {_LAST_CHANGE} WHERE _deleted IS NOT TRUE")
def cdc_to_merge(s, d):
    rows = applied(s, d).withColumn("_arrival", F.col("lsn") * 100 + F.col("seq"))
    return merge.upsert(target(s, d).select("user_id", "event_type", "value"), rows, MergeSpec(("user_id",), "_arrival", hard_delete="_deleted"))


@query("SELECT min(last) AS ack FROM (SELECT user_id % 4, max(event_id) AS last FROM events GROUP BY 1)")
def cdc_ack_floor(s, d):
    per_stream = events(s, d).groupBy((F.col("user_id") % 4).alias("stream")).agg(F.max("event_id").alias("cursor"))
    return changes.acknowledge(per_stream)


from . import catalog_io  # noqa: E402, F401  the queries of sources and destinations
