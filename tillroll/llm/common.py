"""Helpers shared by the operators: shared scratch tables, text words, hashes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tillroll.session import scratch_path, staged  # noqa: F401 - scratch_path is for the operators


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package's modules to the executors, once per application.

    Python workers import the operators' functions by name; without this they
    would need the package installed on every machine.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="tillroll-ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(at, "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        context.addPyFile(str(at))
        _SHIPPED.add(context.applicationId)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    running the steps before again.
    """
    return staged(df, name)


def crc32_of_id(col):
    """Unsigned crc32 of an id written as decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(docs: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words the words' 64-bit hashes; each distinct word is hashed once."""
    known = {w: xxhash.xxh64_intdigest(w) for w in set().union(*docs)} if docs else {}
    return [np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws)) for ws in docs]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit values over the whole range."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Odd multipliers that make the position of a word in an n-gram count.
_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` words, in order of position."""
    if len(w) < n:
        return np.empty(0, np.uint64)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = mix(h * _STEP + w[k:len(w) - n + 1 + k])
    return h


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def slices(keys: np.ndarray, n: int) -> np.ndarray:
    """Edges of the ``n`` slices of sorted keys, by equal ranges of the key."""
    step = np.uint64((1 << 64) // n if n > 1 else 0)
    cut = np.searchsorted(keys, np.arange(1, n, dtype=np.uint64) * step)
    return np.concatenate([[0], cut, [len(keys)]])


_ZSTD = pa.Codec("zstd", compression_level=1)


def packed(values: np.ndarray) -> bytes:
    """Bytes by place value, behind their number, compressed: most numbers are small, which the shuffle's lz4 uses less."""
    v = np.ascontiguousarray(values)
    plain = v.view(np.uint8).reshape(len(v), v.itemsize).T.tobytes()
    return len(plain).to_bytes(8, "little") + _ZSTD.compress(plain, asbytes=True) if plain else b""


def unpacked(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    plain = _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little")) if data else b""
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def free_prefix(df: DataFrame) -> str:
    """A prefix with which no column of the table begins."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def append_columns(df: DataFrame, inputs: list[str], added: str, fn, rows: int = 512, drop: tuple = ()) -> DataFrame:
    """Add the columns of the DDL string ``added``, computed by ``fn`` from the columns ``inputs``.

    ``fn`` gets one list of Python values per input, for up to ``rows`` rows at
    a time, and returns one list or Arrow array per added column. All other columns pass
    through as Arrow data, unchanged; added columns replace those of the same
    name (case ignored), and the columns in ``drop`` are left out.
    """
    new = StructType.fromDDL(added)
    gone = {f.name.lower() for f in new} | {c.lower() for c in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    names = [f.name for f in kept]
    types = [to_arrow_type(f.dataType) for f in new]
    # inputs that are replaced are read under another name
    free = free_prefix(df)
    source = df.select(*[F.col(f"`{n}`") for n in names],
                       *[F.col(f"`{c}`").alias(f"{free}{k}") for k, c in enumerate(inputs)])
    schema = StructType(kept + list(new))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ins = [part.column(len(names) + k).to_pylist() for k in range(len(inputs))]
                outs = [v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t)
                        for v, t in zip(fn(*ins), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(names))] + outs, names=[f.name for f in schema])

    ship(df.sparkSession)
    return source.mapInArrow(run, schema)
