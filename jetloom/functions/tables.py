"""Kernels as SQL table functions: ``SELECT * FROM jets(TABLE(SELECT ...) PARTITION BY (event_id), 0.4)``.

Each takes the rows of one partition (an event, or a jet), gathers them and gives its rows. Result columns follow from the arguments, and
wrong ones are refused when a statement is analysed, before anything runs: the input must have the columns that the kernel needs, be
partitioned by a key, and a radius must be a positive constant.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from jetloom.operators import clustering

DOUBLE, INT = T.DoubleType(), T.IntegerType()
NUMBERS = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)

MOMENTUM = ("energy", "px", "py", "pz")
#: Particles of an event up to which plain numbers are quicker than arrays.
FEW, INFINITE = 30, (float("inf"), float("-inf"))


def _checked(table: AnalyzeArgument, key: str, needed: tuple[str, ...]) -> T.DataType:
    """The key's type, if the table has it and numbers in the needed columns."""
    if not table.isTable:
        raise ValueError("the first argument is TABLE(...) PARTITION BY a key")
    columns = {f.name: f.dataType for f in table.dataType.fields}
    lacking = [c for c in (key, *needed) if c not in columns]
    if lacking:
        raise ValueError(f"the table lacks {', '.join(lacking)}")
    wrong = [c for c in needed if not isinstance(columns[c], NUMBERS)]
    if wrong:
        raise ValueError(f"{', '.join(wrong)} must be numbers")
    return columns[key]


def _positive(argument: AnalyzeArgument, name: str) -> float:
    if not argument.isConstantExpression or argument.value is None or not float(argument.value) > 0:
        raise ValueError(f"{name} is a positive constant")
    return float(argument.value)


class _Gathered:
    """Rows of a partition until it ends; a key's rows come one after another."""

    columns: tuple[str, ...] = ()
    key = "event_id"
    #: The key's and the columns' places by the names of a table's columns: a key's rows are few, so they are looked up once for all keys.
    known: dict[tuple, tuple] = {}

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.at = None
        self.own = itemgetter(0)
        self.place = 0

    def eval(self, row: Row, *_) -> None:
        values = tuple(row)
        if not self.rows:
            names = (self.columns, *row.__fields__)
            if names not in self.known:
                self.known[names] = (names.index(self.key, 1) - 1, itemgetter(*[names.index(c, 1) - 1 for c in self.columns]))
            self.place, self.own = self.known[names]
            self.at = values[self.place]
        elif values[self.place] != self.at:
            raise ValueError(f"the table must be partitioned by {self.key}")
        self.rows.append(self.own(values))

    def ordered(self) -> np.ndarray:
        return np.array(sorted(self.rows), float).reshape(len(self.rows), len(self.columns))


@udtf
class Jets(_Gathered):
    """event_id, jet_id, px, py, pz, energy, constituents: inclusive jets of particles (event_id, pidx, energy, px, py, pz) by a radius."""

    columns = ("pidx", *MOMENTUM)

    @staticmethod
    def analyze(table: AnalyzeArgument, radius: AnalyzeArgument) -> AnalyzeResult:
        key = _checked(table, "event_id", ("pidx", "energy", "px", "py", "pz"))
        _positive(radius, "the radius")
        fields = [("event_id", key), ("jet_id", INT), *[(c, DOUBLE) for c in ("px", "py", "pz", "energy")], ("constituents", T.ArrayType(INT))]
        return AnalyzeResult(T.StructType([T.StructField(n, t) for n, t in fields]))

    def eval(self, row: Row, radius: float) -> None:
        super().eval(row)
        self.radius = radius

    def terminate(self) -> Iterator[tuple]:
        if self.rows and len(self.rows) <= FEW and not any(x is None or x != x or x in INFINITE for r in self.rows for x in r):
            rows = sorted(self.rows)
            for n, (p, own) in enumerate(clustering.single_jets([tuple(map(float, r[1:])) for r in rows], float(self.radius))):
                yield self.at, n, p[1], p[2], p[3], p[0], [int(rows[i][0]) for i in own]
        elif self.rows:
            self.radius = float(self.radius)
            rows = self.ordered()
            for n, (p, own) in enumerate(clustering.jets_of_events([rows[:, 1:]], self.radius)[0]):
                yield self.at, n, float(p[1]), float(p[2]), float(p[3]), float(p[0]), [int(rows[i, 0]) for i in own]


@udtf
class Thrust(_Gathered):
    """event_id, thrust of particles (event_id, px, py, pz); NULL without momentum."""

    columns = ("px", "py", "pz")

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        key = _checked(table, "event_id", ("px", "py", "pz"))
        return AnalyzeResult(T.StructType([T.StructField("event_id", key), T.StructField("thrust", DOUBLE)]))

    def terminate(self) -> Iterator[tuple]:
        if self.rows:
            value = clustering.single_thrust(self.rows)
            yield self.at, None if np.isnan(value) else value


@udtf
class Substructure(_Gathered):
    """The key and the groomed masses and subjettiness of particles (key, pt, eta, phi) of one jet; the key is named ``jet_key``."""

    columns, key = ("pt", "eta", "phi"), "jet_key"

    @staticmethod
    def analyze(table: AnalyzeArgument, r0: AnalyzeArgument) -> AnalyzeResult:
        key = _checked(table, "jet_key", ("pt", "eta", "phi"))
        _positive(r0, "r0")
        return AnalyzeResult(T.StructType([T.StructField("jet_key", key), *[T.StructField(n, DOUBLE) for n in clustering.SUBSTRUCTURE]]))

    def eval(self, row: Row, r0: float) -> None:
        super().eval(row)
        self.r0 = float(r0)

    def terminate(self) -> Iterator[tuple]:
        if self.rows:
            yield (self.at, *map(float, clustering.substructure_of([np.array(self.rows, float)], self.r0)[0]))


@arrow_udtf(returnType="event_id bigint, jet_id int, px double, py double, pz double, energy double, constituents array<int>")
class EventJets:
    """As ``Jets`` of events that are rows already (event_id, a long, and the list ``particles`` of structs pidx, energy, px, py, pz), many at a time.

    Functions of batches cannot look at their arguments before a job runs; wrong ones fail in it.
    """

    def eval(self, events: pa.RecordBatch, radius: pa.Array) -> Iterator[pa.Table]:
        if not (len(radius) and radius[0].is_valid and radius[0].as_py() > 0):
            raise ValueError("the radius is a positive constant")
        lists = events.column("particles")
        particles = lists.flatten()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(int)
        column = lambda c: pc.struct_field(particles, c).to_numpy(zero_copy_only=False).astype(float)
        found = clustering.jets_of(clustering.Groups(sizes, np.column_stack([column(c) for c in MOMENTUM])), float(radius[0].as_py()))
        event = np.repeat(np.arange(len(sizes)), found.counts)  # of each jet
        first = np.repeat((np.cumsum(sizes) - sizes)[event], found.sizes)
        ids = pa.array(pc.struct_field(particles, "pidx").to_numpy(zero_copy_only=False)[first + found.constituents], pa.int32())
        own = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(found.sizes)]), pa.int32()), ids)
        number = np.arange(len(event)) - np.repeat(np.cumsum(found.counts) - found.counts, found.counts)
        columns = [events.column("event_id").cast(pa.int64()).take(pa.array(event)), pa.array(number, pa.int32()), *[pa.array(np.ascontiguousarray(found.p4[:, k])) for k in (1, 2, 3, 0)], own]
        yield pa.table(columns, names=["event_id", "jet_id", "px", "py", "pz", "energy", "constituents"])


FUNCTIONS = {"jets": Jets, "event_jets": EventJets, "thrust": Thrust, "substructure": Substructure}


def register(spark: SparkSession) -> None:
    """Makes the functions known to SQL under their names."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
