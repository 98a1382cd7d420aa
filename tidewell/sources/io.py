"""Readers and writers: CSV, Parquet, JDBC, and the incremental scan by high watermark."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, date, datetime
from decimal import Decimal
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidewell.scratch import written

# How CSV files write a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True, place: str | None = None,
) -> DataFrame:
    """A CSV file with a header; the usual signs of a missing value are null. Without a schema types are inferred, which
    reads the file once more. Values may hold line breaks; where none does, ``multi_line=False`` splits large files.

    ``place`` names a column to be added: a row's number in the order of the file (of several: by path), from 1. Rows have no
    other order of their own, so this is what to lag the rows of a file without any order column by."""
    raw = spark.read.csv(path, header=True, multiLine=multi_line, escape='"')
    if place is not None:
        typed = _typed(spark, path, raw.columns, schema, multi_line)
        return _placed(raw, place).select(*typed, F.col(f"`{place}`"))
    return raw.select(*_typed(spark, path, raw.columns, schema, multi_line))


def _placed(raw: DataFrame, place: str) -> DataFrame:
    """Rows of text files with their place. A split's rows come in order and in one task, and a file's splits are told by where
    they begin: rows are written once as they are read, and only a count of each split is sorted."""
    at = written(raw.select(
        F.struct("*").alias("row"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"),
    ), "lines")
    splits = at.groupBy("file", "block").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return at.join(F.broadcast(starts), ["file", "block"]).select("row.*", (F.col("before") + F.col("i") - F.col("first") + 1).alias(place))


def _typed(spark: SparkSession, path: str, columns: list[str], schema: StructType | str | None, multi_line: bool) -> list[Column]:
    """Text columns of a CSV file as what they hold, with the signs of a missing value as null."""
    clean = dict(zip(columns, (F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")) for c in columns), strict=True))
    if schema is None:
        inferred = spark.read.csv(path, header=True, inferSchema=True, multiLine=multi_line, escape='"', nullValue="NA").schema
        kinds = {f.name: f.dataType for f in inferred}
    else:
        kinds = {f.name: f.dataType for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
    return [x.try_cast(kinds.get(c, StringType())).alias(c) for c, x in clean.items()]


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV files with a header in a folder, written side by side; ``one_file`` for results that are small, since one task
    makes it. Of sorted rows the files' names follow the order, so that ``place`` of ``read_csv`` finds it again."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True, escape='"')


def stamped(stem: str, suffix: str = "", now: datetime | None = None) -> str:
    """``stem`` with the time to the second."""
    return f"{stem}_{(now or datetime.now()):%Y%m%d_%H%M%S}{suffix}"


def engineered_name(path: str) -> str:
    p = Path(path)
    return str(p.with_name(f"{p.stem}_engineered{p.suffix or '.csv'}"))


def quoted(*parts: str | None) -> str:
    """A double-quoted name of one, two or three parts; parts that are missing are left out."""
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts if p)


def quoted_columns(*parts: Column) -> Column:
    """``quoted`` of columns; null parts are left out."""
    return F.concat_ws(".", *(F.concat(F.lit('"'), F.replace(p, F.lit('"'), F.lit('""')), F.lit('"')) for p in parts))


def _literal(value: Any) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no watermark: {value}")
    if isinstance(value, int | float | Decimal):
        return str(value)
    if isinstance(value, datetime | date):
        return f"{{{'ts' if isinstance(value, datetime) else 'd'} '{value}'}}"  # every JDBC driver reads these
    return "'" + str(value).replace("'", "''") + "'"


def jdbc_options(config: Any, section: str = "snowflake") -> dict[str, str]:
    """Options of Spark's JDBC reader from a connection section; the driver's jar must be on the class path.

    ``url`` names any database; without it the section must describe a warehouse account. ``options`` are handed on to
    the reader (``driver``, ``fetchsize``, ``partitionColumn`` with its bounds, to read in parallel). Without a password
    the login is by single sign-on in the browser; a role and an authenticator are optional.
    """
    get = lambda k: config.get(f"{section}.{k}", None)
    more = {k: str(v) for k, v in (get("options") or {}).items()}
    if get("url"):
        return {"url": get("url")} | {k: str(get(k)) for k in ("user", "password") if get(k)} | more
    missing = [k for k in ("account", "user", "warehouse", "database", "schema") if not get(k)]
    if missing:
        raise ValueError(f"connection settings are missing: {missing}")
    out = more | {
        "url": f"jdbc:snowflake://{get('account')}.snowflakecomputing.com/", "user": get("user"),
        "warehouse": get("warehouse"), "db": get("database"), "schema": get("schema"),
    }
    out |= {"password": get("password")} if get("password") else {}
    out |= {"authenticator": get("authenticator") or ("" if get("password") else "externalbrowser")}
    return {k: v for k, v in (out | {"role": get("role") or ""}).items() if v}


class Checkpoint:
    """The last value of a column, with its type, in a log of numbered JSON files beside ``path``.

    A value is written to a new file ``{path}.{number}``, created only if no other writer has it, and no file is ever
    replaced: the newest whole one counts. A run that stops at any point leaves the value of before, or the new one. A file
    that isn't whole is passed over; files older than the newest ``KEPT`` whole ones are removed after a write. A plain file
    at ``path`` itself counts as number 0.

    Files are the driver's; with ``spark`` they may lie in any store that Spark writes to (``path`` is an URI then).
    """

    KEPT = 5

    def __init__(self, path: str, spark: SparkSession | None = None) -> None:
        self.path, self.spark = path, spark

    def _store(self) -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        """The log's numbers, the newest first."""
        if self.spark is None:
            where = Path(self.path)
            found = [p.name for p in where.parent.glob("*")] if where.parent.exists() else []
            name = where.name
        else:
            fs, path = self._store()
            found = [s.getPath().getName() for s in fs.listStatus(path.getParent())] if fs.exists(path.getParent()) else []
            name = path.getName()
        rest = [x[len(name) + 1 :] for x in found if x.startswith(f"{name}.")]
        return sorted([*(int(x) for x in rest if x.isdigit()), *([0] if name in found else [])], reverse=True)

    def _file(self, number: int) -> str:
        return f"{self.path}.{number}" if number else self.path

    def _text(self, number: int) -> str:
        if self.spark is None:
            return Path(self._file(number)).read_text()
        fs, _ = self._store()
        stream = fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(self._file(number)))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, number: int, text: str) -> bool:
        """A new file with that number; False if there is one already."""
        if self.spark is None:
            where = Path(self._file(number))
            where.parent.mkdir(parents=True, exist_ok=True)
            try:
                with where.open("x") as f:
                    f.write(text)
            except FileExistsError:
                return False
            return True
        fs, _ = self._store()
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self._file(number))
        if fs.exists(where):
            return False
        try:
            stream = fs.create(where, False)
        except Exception:
            if fs.exists(where):  # another writer came first
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def _newest(self) -> dict[str, Any] | None:
        for number in self._numbers():
            try:
                kept = json.loads(self._text(number))
            except (ValueError, OSError):
                continue  # not whole: its writer stopped
            if isinstance(kept, dict) and "last_value" in kept:
                return kept
        return None

    def _put(self, text: str) -> None:
        numbers = self._numbers()
        number = (numbers[0] if numbers else 0) + 1
        while not self._create(number, text):
            number += 1
        for old in self._numbers()[self.KEPT :]:
            if old and old < number:
                self._drop(old)

    def _drop(self, number: int) -> None:
        if self.spark is None:
            Path(self._file(number)).unlink(missing_ok=True)
        else:
            self._store()[0].delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._file(number)), False)

    def read(self) -> Any:
        kept = self._newest()
        if kept is None:
            return None
        value, kind = kept.get("last_value"), kept.get("type", "")
        make: dict[str, Callable[[Any], Any]] = {"datetime": datetime.fromisoformat, "date": date.fromisoformat, "Decimal": Decimal}
        return make[kind](value) if kind in make and value is not None else value

    def write(self, value: Any) -> None:
        plain = value if isinstance(value, int | float | str) else value.isoformat() if hasattr(value, "isoformat") else str(value)
        self._put(json.dumps({"last_value": plain, "type": type(value).__name__, "updated_at": datetime.now(UTC).isoformat()}))


def _ranges(name: str, cuts: list[str]) -> list[str]:
    """Conditions of the ranges between rising cuts; null goes with the first."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({name} <= {cuts[0]} OR {name} IS NULL)", *middle, f"{name} > {cuts[-1]}"]


class Loader:
    """Full and incremental scans of a table: a DataFrame (files, catalog) or a JDBC table."""

    def __init__(self, spark: SparkSession, table: DataFrame | None = None, jdbc: dict[str, str] | None = None, name: str = "") -> None:
        self.spark, self.table, self.jdbc, self.name = spark, table, jdbc, name

    def execute(self, sql: str) -> DataFrame:
        if not self.jdbc:
            raise RuntimeError("not connected")
        by_parts = "partitionColumn" in self.jdbc  # Spark takes a table then, not a query
        return self.spark.read.format("jdbc").options(**self.jdbc).option(
            "dbtable" if by_parts else "query", f"({sql}) t" if by_parts else sql,
        ).load()

    def bounds(self, column: str, parts: int, where: str = "") -> list[str]:
        """Conditions that cut the table into ``parts`` ranges of ``column``, which together hold every row: null goes with the
        first range. Numbers and dates are cut evenly between the least and the largest value, which the database finds."""
        name = quoted(column)
        if isinstance(self.execute(f"SELECT {name} FROM {self.name}").schema[0].dataType, StringType):
            raise ValueError(f"{column} has no numbers or dates to be cut evenly")
        low, high = self.execute(f"SELECT min({name}) AS lo, max({name}) AS hi FROM {self.name}{where}").first()
        if low is None or parts < 2 or low == high:
            return ["1 = 1"]
        steps = [low + (high - low) * Decimal(i) / parts if isinstance(low, Decimal) else low + (high - low) * i / parts for i in range(1, parts)]
        if isinstance(low, int):
            steps = [int(x) for x in steps]
        return _ranges(name, list(dict.fromkeys(map(_literal, steps))))

    def load_ranges(self, column: str, parts: int, checkpoint: Checkpoint | None = None, even: bool = True) -> DataFrame:
        """A JDBC table read by ``parts`` tasks side by side, each a range of ``column``: even ones, or with ``even=False`` such
        that hold about the same number of rows (the column alone is read first for that). With a checkpoint only rows beyond
        it: the condition goes into every range, so the database never scans what is known."""
        if not self.jdbc:
            raise RuntimeError("not connected")
        last = checkpoint.read() if checkpoint else None
        newer = f"{quoted(column)} > {_literal(last)}" if last is not None else ""
        options = {k: v for k, v in self.jdbc.items() if k not in ("url", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
        read = lambda name, ranges: self.spark.read.jdbc(
            self.jdbc["url"], name, predicates=[f"{r} AND {newer}" if newer else r for r in ranges], properties=options,
        )
        ranges = self.bounds(column, parts, f" WHERE {newer}" if newer else "")
        if not even and len(ranges) > 1:
            keys = read(self.name, ranges).select(F.col(f"`{column}`").alias("k"))
            shares = F.array(*(F.lit(i / parts) for i in range(1, parts)))
            found = keys.agg(F.percentile_approx("k", shares, F.lit(100 * parts)).alias("cuts")).first().cuts or []
            ranges = _ranges(quoted(column), [_literal(x) for x in dict.fromkeys(found)])
        return read(self.name, ranges)

    def test_connection(self) -> bool:
        try:
            (self.table if self.table is not None else self.execute(f"SELECT * FROM {self.name}")).limit(1).collect()
        except Exception:  # noqa: BLE001  any failure to read is the answer
            return False
        return True

    def load_data(self, limit: int | None = None) -> DataFrame:
        if self.table is None:
            return self.execute(f"SELECT * FROM {self.name}" + (f" LIMIT {int(limit)}" if limit is not None else ""))
        return self.table if limit is None else self.table.limit(limit)

    def load_delta(self, column: str, checkpoint: Checkpoint, limit: int | None = None) -> DataFrame:
        """Rows beyond the checkpoint, all of them at first; with a limit the lowest ones, so none is ever skipped.

        The checkpoint moves only when commit() is called, after the rows have been written.
        """
        last = checkpoint.read()
        if self.table is None:
            where = "" if last is None else f" WHERE {quoted(column)} > {_literal(last)}"
            return self.execute(
                f"SELECT * FROM {self.name}{where}" + (f" ORDER BY {quoted(column)} LIMIT {int(limit)}" if limit is not None else "")
            )
        rows = self.table if last is None else self.table.filter(
            F.col(f"`{column}`") > F.lit(last).cast(self.table.schema[column].dataType)
        )
        return rows if limit is None else rows.orderBy(column).limit(limit)

    @staticmethod
    def commit(rows: DataFrame, column: str, checkpoint: Checkpoint) -> Any:
        """Move the checkpoint to the largest value of rows that were written; no rows, no move."""
        top = rows.agg(F.max(F.col(f"`{column}`"))).first()[0] if column in rows.columns else None
        if top is not None:
            checkpoint.write(top)
        return top
