"""The arrivals fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from landfall import schemas
from landfall.functions import days
from landfall.operators.upsert import dense_keys

# Each batch day owns 2^47 ids. Within it an id holds the class of the split, the task and
# the row's place in the task; the later a task, the more of the bits are its number, so
# that any number of tasks finds room: up to 2^24, by the (task, place) bits of four classes.
_DAY_BITS = 47
_SPLITS = ((12, 33), (16, 29), (20, 25), (24, 21))
_PLACE_BITS = 33  # of monotonically_increasing_id(); the task is above them


@dataclass(frozen=True)
class FactCounts:
    """What became of the arrivals of a batch; a first unknown code counts."""

    arrivals: int
    no_country: int
    no_port: int
    loaded: int


def build_fact(staging: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """Arrivals with known country and port.

    Both dimensions come from tables, so their true size is known and they are
    broadcast when small; the arrivals are then neither shuffled nor skewed.
    """
    return _fact_columns(
        staging
        .join(countries.select("country_id", "country_code"), "country_code")
        .join(ports.select("port_id", "port_code"), "port_code"))


def _fact_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "country_id", "port_id", F.col("age").cast("int").alias("age"),
        F.col("mode").alias("travel_mode"), "visa_category",
        F.col("visatype").alias("visa_type"), "gender",
        F.col("birth_year").cast("int").alias("birth_year"),
        F.rint("depdate").cast("int").alias("depdate"),
        "load_day", F.rint("arrdate").cast("int").alias("arrdate"))


def broadcastable(df: DataFrame) -> bool:
    """Whether the optimizer's estimate of the size allows a broadcast."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def hot_codes(codes: DataFrame, key: str, tasks: int) -> DataFrame:
    """(key, salts) of the codes with more arrivals than a task's even share, from the
    code_counts of the batch. There are fewer than `tasks` of them, NULL included."""
    total = codes.agg(F.sum("arrivals")).first()[0] or 0
    share = F.lit(max(1, -(-total // tasks)))
    return (codes.groupBy(key).agg(F.sum("arrivals").alias("arrivals"))
            .where(F.col("arrivals") > share)
            .select(key, F.ceil(F.col("arrivals") / share).cast("long").alias("salts")))


def _salted_join(rows: DataFrame, dim: DataFrame, key: str, hot: DataFrame,
                 matches: Column) -> DataFrame:
    """Left join in which the rows of a hot key are dealt over several tasks, to each of
    which that key's row of the dimension goes. Rows with a NULL key are dealt alike."""
    # Fewer rows than tasks, by the bound of hot_codes.
    few = F.broadcast(hot.select(F.col(key).alias("_hot"), "salts"))
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    dealt = rows.join(few, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), salts)).drop("_hot", "salts")
    copied = dim.join(few, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_hot", "salts")
    copied = copied.withColumnsRenamed({key: "_key", "_salt": "_place"})
    return dealt.join(
        copied, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_place")) & matches,
        "left").drop("_key", "_salt", "_place")


def observed_fact(staging: DataFrame, countries: DataFrame, ports: DataFrame,
                  codes: DataFrame | None = None, shuffled: bool | None = None
                  ) -> tuple[DataFrame, Observation]:
    """build_fact with counts of all arrivals and of those it leaves out, taken while its
    rows are written.

    When a dimension is too big to broadcast (or `shuffled` says so), hot codes, found from
    the batch's code_counts, are salted, and the joined rows are brought together by
    partition, or every task would open a file in each of them. Left as they are when
    both dimensions are broadcast: the rows are then in the order of the lake.
    """
    some = countries.select("country_id", "country_code")
    more = ports.select("port_id", "port_code")
    if shuffled is None:
        shuffled = not (broadcastable(some) and broadcastable(more))
    # Without a country a port is of no use, nor is its being there more than once.
    known = F.col("country_id").isNotNull()
    if shuffled:
        if codes is None:
            raise ValueError("a shuffled join needs the code_counts of the batch")
        tasks = int(staging.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        some, more = some.hint("merge"), more.hint("merge")
        joined = _salted_join(staging, some, "country_code",
                              hot_codes(codes, "country_code", tasks), F.lit(True))
        joined = _salted_join(joined, more, "port_code",
                              hot_codes(codes, "port_code", tasks), known)
        joined = joined.hint("rebalance", "load_day", "arrdate")
    else:
        joined = staging.join(some, "country_code", "left")
        joined = joined.join(more.withColumnRenamed("port_code", "_key"),
                             (F.col("port_code") == F.col("_key")) & known, "left")
    seen = Observation()
    port = F.col("port_id").isNotNull()
    # After the shuffle, if any: a task of the write then counts once, also when it is tried
    # again.
    observed = joined.observe(
        seen, F.count_if(~known).alias("no_country"), F.count_if(known & ~port).alias("no_port"),
        F.count_if(port).alias("loaded"), F.count("*").alias("arrivals"))
    return _fact_columns(observed.where(known & port)), seen


def fact_counts(seen: Observation) -> FactCounts:
    """The counts of a fact that has been written. A code that the 'keep' rule holds twice
    makes two arrivals of one."""
    found = seen.get
    return FactCounts(found["arrivals"], found["no_country"], found["no_port"], found["loaded"])


def day_start(load_day: Column) -> Column:
    """First id of a batch day, negative before 1960. Ids of a day depend on no other day,
    so a load needs no look at the fact and days can be re-run in any order. A day whose
    ids would not fit 64 bits is an error."""
    number = days.day_number(load_day).cast("long")
    most = 1 << (63 - _DAY_BITS)
    return F.when(number.isNull() | ((number >= -most) & (number < most)),
                  F.shiftleft(number, _DAY_BITS)).otherwise(
        F.raise_error(F.concat(F.lit("no ids for batch day "), load_day.cast("string")))
        .cast("long"))


def _within_day(at: Column) -> Column:
    """A monotonically_increasing_id() in 47 bits."""
    task = F.shiftright(at, _PLACE_BITS)
    place = at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))

    def refuse(text: str) -> Column:
        return F.raise_error(F.lit(text)).cast("long")

    found = refuse("more tasks than ids hold: use assign_fact_ids(dense=True)")
    for number in reversed(range(len(_SPLITS))):
        tasks, places = _SPLITS[number]
        packed = F.lit(number << (_DAY_BITS - 2)) + F.shiftleft(task, places) + place
        found = F.when(task < 1 << tasks, F.when(place < 1 << places, packed).otherwise(
            refuse("more rows in a late task than ids hold"))).otherwise(found)
    return found


def assign_fact_ids(fact: DataFrame, start: int | Column = 0, dense: bool = False) -> DataFrame:
    """Unique immigration_id without a shuffle or a second pass, whatever the tasks.

    Like an identity column the ids have gaps, between tasks. `dense` closes them
    by storing the rows once and counting them per task.
    """
    if dense:
        numbered = dense_keys(fact, "immigration_id", start)
    else:
        base = start if isinstance(start, Column) else F.lit(start).cast("long")
        numbered = fact.withColumn(
            "immigration_id", base + _within_day(F.monotonically_increasing_id()))
    return numbered.select(*schemas.TABLES["fact_immigration"].columns)


def batch_fact(staging: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """Fact rows of one or more batch days, with ids."""
    return assign_fact_ids(build_fact(staging, countries, ports), day_start(F.col("load_day")))


def observed_batch(staging: DataFrame, countries: DataFrame, ports: DataFrame,
                   codes: DataFrame) -> tuple[DataFrame, Observation]:
    """batch_fact of any size, with the counts that its write takes."""
    rows, seen = observed_fact(staging, countries, ports, codes)
    return assign_fact_ids(rows, day_start(F.col("load_day"))), seen
