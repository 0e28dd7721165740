"""Line-order steps over (file_name, split, line_id, value).

``split`` is the byte position where a file split starts and ``line_id`` grows along the lines
of a split, so (split, line_id) is the order of a file. A split is bounded by
``spark.sql.files.maxPartitionBytes``; a file is not, so nothing here sorts a whole file in one
task: only one small row per split is ordered by file, about a million rows for 100 TB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from opslog.fixed import FORMAT_CHECK_LINES
from opslog.functions.lines import dated_month, starts_like_log_line


def _splits_before() -> Window:
    """The splits of the same file before the one at hand."""
    return (
        Window.partitionBy("file_name").orderBy("split")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def carried_months(lines: DataFrame) -> DataFrame:
    """One row per split with the last month seen in the file before that split.

    The month is aggregated as a number (200506): with a text in its buffer Spark would sort
    all lines before merging them, with a number it merges them in a hash map.
    """
    month = F.replace(dated_month(F.col("value")), F.lit("-"), F.lit("")).cast("int")
    last_in_split = (
        lines.select("file_name", "split", "line_id", month.alias("number"))
        .groupBy("file_name", "split")
        .agg(F.max_by("number", F.when(F.col("number").isNotNull(), F.col("line_id"))).alias("number"))
    )
    before = F.last("number", ignorenulls=True).over(_splits_before())
    text = F.lpad(F.col("before").cast("string"), 6, "0")
    return last_in_split.withColumn("before", before).select(
        "file_name", "split",
        F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2)).alias("month"),
    )


def lines_with_carry(lines: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """The lines plus, at the head of every split, a marker row that holds the carried month.

    The marker travels with its split, so the carried month needs no join and no broadcast. A
    caller that has stored ``carried`` saves the scan that computes it.
    """
    marker = (carried_months(lines) if carried is None else carried).select(
        "file_name", "split", F.lit(-1).cast("bigint").alias("line_id"),
        F.lit(None).cast("string").alias("value"), F.col("month").alias("carried"),
    )
    return lines.select(
        "file_name", "split", "line_id", "value", F.lit(None).cast("string").alias("carried")
    ).unionByName(marker)


def fill_months(with_carry: DataFrame, task_keys: list[str] | None = None) -> DataFrame:
    """Give every line the month of the nearest dated line at or before it.

    Lines before the first dated line of a file have none and are dropped. ``task_keys`` name
    columns whose groups hold whole splits; by default each split is a group.
    """
    keys = ["file_name", "split"]
    so_far = (
        Window.partitionBy(*task_keys).orderBy(*keys, "line_id") if task_keys
        else Window.partitionBy(*keys).orderBy("line_id")
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The marker of a split ends what an earlier split of the group carried, also with no month.
    marker = F.when(F.col("line_id") < 0, F.coalesce("carried", F.lit("")))
    own = F.coalesce(marker, dated_month(F.col("value")))
    return (
        with_carry.withColumn("own", own)
        .withColumn("month", F.last("own", ignorenulls=True).over(so_far))
        .filter((F.col("line_id") >= 0) & (F.col("month") != ""))
        .select("month", "file_name", "split", "line_id", "value")
    )


def split_by_month(lines: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    return fill_months(lines_with_carry(lines, carried))


@dataclass(frozen=True)
class SplitOrder:
    """The place of every split in the order of the files, as an id of an output partition.

    All files of a scan are cut at multiples of ``step`` bytes, so the place follows from the
    split itself and from the number of splits in the files before: ``bases`` has one entry
    (file_name, part, splits before it) per file, in order.
    """

    bases: tuple[tuple[str, str, int], ...]
    step: int
    count: int

    @staticmethod
    def of(splits: DataFrame) -> SplitOrder | None:
        """From one row per split (file_name, split). Only one row per file reaches the driver;
        with more files than ``FILES_AT_ONCE`` there is no order of this kind."""
        start = F.col("split.start")
        files = splits.groupBy("file_name", F.col("split.part").alias("part")).agg(
            F.max(start).alias("last"), F.min(F.when(start > 0, start)).alias("step"))
        rows = files.orderBy("file_name", "part").limit(FILES_AT_ONCE + 1).collect()
        if len(rows) > FILES_AT_ONCE:
            return None
        step, count, bases = min((r["step"] for r in rows if r["step"]), default=1), 0, []
        for row in rows:
            bases.append((row["file_name"], row["part"], count))
            count += row["last"] // step + 1
        return SplitOrder(tuple(bases), step, max(count, 1))

    def partitions(self, wanted: int) -> int:
        return -(-self.count // self._per(wanted))

    def _per(self, wanted: int) -> int:
        return -(-self.count // max(1, wanted))

    def arrange(self, lines: DataFrame, wanted: int) -> DataFrame:
        """One exchange by the known place; adds ``place``. About ``wanted`` partitions.

        The join has one row per file on its small side, at most ``FILES_AT_ONCE``.
        """
        known = lines.sparkSession.createDataFrame(
            [(part, base) for _, part, base in self.bases], "known_part string, splits_before bigint")
        ordinal = F.col("splits_before") + F.floor(F.col("split.start") / F.lit(self.step))
        return (
            lines.join(F.broadcast(known), F.col("split.part") == F.col("known_part"))
            .withColumn("place", F.floor(ordinal / F.lit(self._per(wanted))).cast("int"))
            .drop("known_part", "splits_before")
            .repartitionById(self.partitions(wanted), "place")
        )


class Tally:
    """Exact counts of the values of a column, taken while its rows pass on to something else.

    Spark's sketch of the most frequent values is exact while it holds all of them; ``counts``
    is None if there were too many, or if the counts do not add up to all rows.
    """

    MOST = 10_000

    def __init__(self, value: Column) -> None:
        self.value, self.seen = value, Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        sketch = F.call_function("approx_top_k", self.value, F.lit(self.MOST), F.lit(10 * self.MOST))
        return rows.observe(self.seen, sketch.alias("top"), F.count(self.value).alias("all"))

    def counts(self) -> dict[str, int] | None:
        got = self.seen.get
        found = {row["item"]: row["count"] for row in got["top"] or [] if row["item"] is not None}
        return found if len(found) < self.MOST and sum(found.values()) == got["all"] else None


#: Files whose names are sent to every executor at once: some 15 MB of paths.
FILES_AT_ONCE = 100_000


def split_in_file_order(
    lines: DataFrame, partitions: int, carried: DataFrame, order: SplitOrder | None = None
) -> DataFrame:
    """``split_by_month`` for writing: partitions and rows follow the order of the files.

    With an ``order`` the exchange needs no sample of the lines; without one it is by range.
    Either keeps a split in one task, so the window needs no second shuffle. Month comes first
    in the final sort because the writer groups by it; within a month the line order stays.
    """
    spread = lines_with_carry(lines, carried)
    keys = ["file_name", "split"]
    if order is None:
        filled = fill_months(spread.repartitionByRange(partitions, *keys))
    else:
        filled = fill_months(order.arrange(spread, partitions), ["place"])
    return filled.sortWithinPartitions("month", *keys, "line_id")


def split_counts(lines_by_month: DataFrame) -> DataFrame:
    return lines_by_month.groupBy("month").agg(F.count("*").alias("line_count"))


def split_sums(
    lines: DataFrame, check_lines: int = FORMAT_CHECK_LINES, digest: Digest | None = None
) -> DataFrame:
    """One row per split: line count, bytes with line ends, first position, and how many of its
    lines that stand among the first ``check_lines`` of the scan task start like a log line.

    With a ``digest`` there are also sums of line hashes for a fingerprint.
    """
    position = _position(F.col("line_id"))
    counted = (position < check_lines) & starts_like_log_line(F.col("value"))
    measures = {
        "lines": F.count("*"), "bytes": F.sum(F.octet_length("value") + F.lit(1)),
        "first": F.min(position), "starts": F.count_if(counted),
    }
    if digest is not None:
        measures |= _split_sums(digest)
    return lines.groupBy("file_name", "split").agg(
        *(measure.alias(name) for name, measure in measures.items())
    )


def place_splits(sums: DataFrame) -> DataFrame:
    """Add the number of lines in the file before each split, and in the whole file."""
    whole = Window.partitionBy("file_name")
    before = F.coalesce(F.sum("lines").over(_splits_before()), F.lit(0).cast("bigint"))
    return sums.withColumn("lines_before", before).withColumn("all_lines", F.sum("lines").over(whole))


def files_from_splits(splits: DataFrame, check_lines: int = FORMAT_CHECK_LINES) -> DataFrame:
    """file_name, line_count, fingerprint where there are sums, and starts.

    ``starts`` is the number of valid lines among the first ``check_lines`` of the file if the
    splits tell it, which they do when the first split was alone in its scan task from the
    start on and holds all of these lines; else it is null. The first split travels through
    the aggregate as a struct, so nothing is joined back.
    """
    head = F.max(F.when(F.col("lines_before") == 0, F.struct("first", "lines", "starts")))
    totals = {"line_count": F.sum("lines"), "head": head}
    if "placed" in splits.columns:
        totals["fingerprint"] = _fingerprint()
    files = splits.groupBy("file_name").agg(*(total.alias(name) for name, total in totals.items()))
    whole = (F.col("head.lines") >= check_lines) | (F.col("head.lines") == F.col("line_count"))
    told = (F.col("head.first") == 0) & whole
    return files.withColumn("starts", F.when(told, F.col("head.starts"))).drop("head")


def _head_lines(lines: DataFrame, splits: DataFrame, check_lines: int, *extra: str) -> DataFrame:
    """The first ``check_lines`` lines of every file, from the splits that hold them."""
    heads = splits.filter(F.col("lines_before") < check_lines).select(
        "file_name", "split", "lines_before", *extra)
    in_split = F.row_number().over(Window.partitionBy("file_name", "split").orderBy("line_id"))
    return (
        lines.join(heads, ["file_name", "split"])
        .withColumn("line_no", F.col("lines_before") + in_split)
        .filter(F.col("line_no") <= check_lines)
    )


def head_starts(
    lines: DataFrame, splits: DataFrame, check_lines: int = FORMAT_CHECK_LINES
) -> DataFrame:
    """``starts`` by numbering the lines of the splits that hold the first ``check_lines``."""
    return _head_lines(lines, splits, check_lines).groupBy("file_name").agg(
        F.count_if(starts_like_log_line(F.col("value"))).alias("starts"))


def valid_share(check_lines: int = FORMAT_CHECK_LINES) -> Column:
    return F.col("starts") / F.least(F.col("line_count"), F.lit(check_lines))


def inspect_files(lines: DataFrame, check_lines: int = FORMAT_CHECK_LINES) -> DataFrame:
    """Line count, size, and the share of the first ``check_lines`` lines that start like a
    log line. The lines are read twice: for the splits, and the splits at the head again."""
    splits = place_splits(split_sums(lines, check_lines)).withColumn(
        "size_bytes", F.sum("bytes").over(Window.partitionBy("file_name")))
    heads = _head_lines(lines, splits, check_lines, "all_lines", "size_bytes")
    return heads.groupBy("file_name").agg(
        F.max("all_lines").alias("line_count"), F.max("size_bytes").alias("size_bytes"),
        F.count_if(starts_like_log_line(F.col("value"))).alias("starts"),
    ).select("file_name", "line_count", "size_bytes", valid_share(check_lines).alias("valid_share"))


# Sums of line hashes for the fingerprint. Products stay below 2^62 because both factors are
# reduced by this prime, and a split has far fewer than 2^31 lines.
_PRIME = 2**31 - 1

# The hash of a line under a seed, as a bigint.
Digest = Callable[[Column, int], Column]


def line_digest(value: Column, seed: int) -> Column:
    return F.xxhash64(value, F.lit(seed)) if seed else F.xxhash64(value)


def _modulo(number: Column) -> Column:
    return F.pmod(number, F.lit(_PRIME).cast("bigint"))


def _position(line_id: Column) -> Column:
    """Row number inside the scan task: the lower 33 bits of the generated id."""
    return line_id.bitwiseAND(F.lit(2**33 - 1).cast("bigint"))


def _content_sums(digest: Column) -> dict[str, Column]:
    """Line count and the two halves of the sum of line hashes; a half fits a bigint for 2^31 lines."""
    return {
        "lines": F.count("*"),
        "low": F.sum(digest.bitwiseAND(F.lit(2**32 - 1).cast("bigint"))),
        "high": F.sum(F.shiftright(digest, 32)),
    }


def _content_totals() -> dict[str, Column]:
    return {name: F.sum(F.col(name).cast("decimal(38,0)")) for name in ("lines", "low", "high")}


def content_by_month(lines: DataFrame) -> DataFrame:
    """Order-free content of ``value`` by ``month``, summed per task first."""
    sums = _content_sums(line_digest(F.col("value"), 0))
    per_task = lines.groupBy("month", F.spark_partition_id().alias("task")).agg(
        *(measure.alias(name) for name, measure in sums.items())
    )
    return per_task.groupBy("month").agg(*(t.alias(n) for n, t in _content_totals().items()))


def content_by_file(splits: DataFrame) -> DataFrame:
    """The same content for files, from stored splits with a fingerprint."""
    return splits.groupBy("file_name").agg(*(t.alias(n) for n, t in _content_totals().items()))


# Two order terms under different seeds: together 62 bits.
_ORDER_SEEDS = {"": 0, "_again": 1}


def _split_sums(digest: Digest) -> dict[str, Column]:
    value, position = F.col("value"), _modulo(_position(F.col("line_id")))
    sums = {k: v for k, v in _content_sums(digest(value, 0)).items() if k != "lines"}
    for name, seed in _ORDER_SEEDS.items():
        hashed = _modulo(digest(value, seed))
        sums |= {f"plain{name}": F.sum(hashed), f"placed{name}": F.sum(_modulo(hashed * position))}
    return sums


def _fingerprint() -> Column:
    """'lines:low:high:order:order'. An order term is the sum of hash x line number in the file:
    moving the first line of a split to its place in the file shifts ``placed`` by a multiple of
    ``plain``. It does not depend on where splits begin, nor on a newline after the last line."""
    orders = []
    for name in _ORDER_SEEDS:
        shift = _modulo(F.col("lines_before") - F.col("first")) * _modulo(F.col(f"plain{name}"))
        order = F.sum(_modulo(F.col(f"placed{name}") + _modulo(shift)).cast("decimal(38,0)"))
        orders.append(order % F.lit(_PRIME))
    parts = [*_content_totals().values(), *orders]
    return F.concat_ws(":", *(part.cast("string") for part in parts))
