"""What is outside Spark, by contract: opening, rendering, models, and writing files.

An adapter is a function from Arrow batches to Arrow batches, made by ``load`` once in a
task. ``through`` runs it on the rows that reach it. A batch that an adapter refuses is
tried row by row; a row that fails keeps its key and has the message in ``error`` and
nulls in the columns the adapter gives, so a failure is data: ``succeeded`` and
``failures`` divide the two. Null and repeated keys are passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from ..sources.shipping import ship

BOX = "x0:double, y0:double, x1:double, y1:double"


@dataclass(frozen=True)
class Contract:
    """The columns an adapter takes, those of them that it keeps, and the columns it gives; several rows for one if ``many``."""

    name: str
    takes: tuple[str, ...]
    keeps: tuple[str, ...]
    gives: str
    many: bool = False


OPEN = Contract("open", ("path", "content"), ("path",), "page_num int, page_w double, page_h double, existing_text string", many=True)
RENDER = Contract("render", ("path", "page_num", "content", "dpi"), ("path", "page_num"), "width int, height int, pixels binary")
LAYOUT = Contract("layout", ("page_id", "width", "height", "pixels"), ("page_id",),
    f"regions array<struct<{BOX}, label:string, position:int, top_k:map<string,double>>>, image_bbox array<double>")
DETECT = Contract("detect", ("page_id", "width", "height", "pixels"), ("page_id",), f"lines array<struct<{BOX}, confidence:double>>")
RECOGNISE = Contract("recognise", ("page_id", "line_no", "pixels"), ("page_id", "line_no"), "text string, confidence double")
READ = Contract("read", ("page_id", "region_id", "pixels", "pass"), ("page_id", "region_id", "pass"), f"reads array<struct<{BOX}, text:string, confidence:double>>")
SAVE = Contract("save", ("name", "content", "layer"), ("name",), "content binary, bytes long, chars long")
INTENT = Contract("intent", ("name", "content", "profile"), ("name",), "content binary")
CONTRACTS = (OPEN, RENDER, LAYOUT, DETECT, RECOGNISE, READ, SAVE, INTENT)


def through(rows: DataFrame, contract: Contract, load: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """What the contract keeps and gives, and ``error``; a column that is kept and given is the given one.

    For one row that several come of, the adapter gives the kept columns too, so that
    the rows can be told apart.
    """
    missing = [c for c in contract.takes if c not in rows.columns]
    if missing:
        raise ValueError(f"{contract.name} needs the columns {missing}")
    taken = rows.select(*contract.takes)
    given = StructType.fromDDL(contract.gives)
    schema = StructType([f for f in taken.schema if f.name in contract.keeps and f.name not in given.names] + given.fields).add("error", StringType())
    arrow = to_arrow_schema(schema)
    kept = [n for n in arrow.names if n in contract.keeps and n not in given.names]
    named, many = contract.name, contract.many

    def made(model, batch: pa.RecordBatch) -> pa.RecordBatch:
        got = model(batch)
        if not many and got.num_rows != batch.num_rows:
            raise ValueError(f"{named} gave {got.num_rows} rows for {batch.num_rows}")
        source = got if many else batch
        columns = [source.column(n) if n in kept else pa.nulls(got.num_rows, arrow.field(n).type) if n == "error" else got.column(n) for n in arrow.names]
        return pa.RecordBatch.from_arrays([c.cast(arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow)

    def failed(row: pa.RecordBatch, why: Exception) -> pa.RecordBatch:
        columns = [row.column(n) if n in kept else pa.array([f"{type(why).__name__}: {why}"]) if n == "error" else pa.nulls(1, arrow.field(n).type) for n in arrow.names]
        return pa.RecordBatch.from_arrays([c.cast(arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            try:
                yield made(model, batch)
            except Exception:  # noqa: BLE001  (any row may be what it refuses)
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    try:
                        out = made(model, row)
                    except Exception as e:  # noqa: BLE001
                        out = failed(row, e)
                    yield out

    ship(rows.sparkSession)
    return taken.mapInArrow(run, schema)


def succeeded(done: DataFrame) -> DataFrame:
    return done.where("error is null").drop("error")


def failures(done: DataFrame, level: str, *key: str) -> DataFrame:
    """(level, key, error): a row for each failure, of a line, page or file."""
    return done.where("error is not null").select(F.lit(level).alias("level"), F.concat_ws("/", *[F.col(c).cast("string") for c in key]).alias("key"), "error")


def either_pass(first: Callable, second: Callable) -> Callable:
    """A reader that falls back to another call where the first doesn't know its arguments (an older interface)."""

    def read(*args, **kw):
        try:
            return first(*args, **kw)
        except TypeError:
            return second(*args)

    return read
