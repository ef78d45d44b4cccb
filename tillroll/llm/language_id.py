"""Language identification by a string kernel.

Kernel: two texts share a character n-gram of 1 to 3 letters if both hold it
(presence, blended spectrum); the count of shared n-grams is divided by the
root of the product of both counts. Nyström landmarks make it a fixed number
of features, one-versus-rest kernel ridge regression learns on them, and the
landmarks' part of the product is folded into one matrix of n-grams by
languages with which batches of texts are multiplied.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import append_columns, crc32_of_id, mix, read, ship

#: n-grams are told apart by this many buckets.
BUCKETS = 1 << 16
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(k).isalpha() for k in range(0x110000)])


def ngrams(text: str | None, longest: int = 3) -> np.ndarray:
    """Sorted buckets of the distinct letter n-grams; a run of anything but letters counts as one space.

    The whole text is read. Empty if it is null or has no letter.
    """
    if not text:
        return np.empty(0, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.empty(0, np.int64)
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint64)
    held = np.zeros(BUCKETS, bool)
    h = np.zeros(len(code), np.uint64)
    for n in range(1, longest + 1):
        h = h[:len(code) - n + 1] * np.uint64(0x200003) + code[n - 1:] + np.uint64(1)
        held[(mix(h) >> np.uint64(48)).astype(np.int64)] = True
    return np.flatnonzero(held)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Kernel of every text of ``a`` with every text of ``b`` (lists of bucket arrays)."""
    return _rows(a) @ _rows(b).T


def _rows(sets: list[np.ndarray]) -> np.ndarray:
    m = np.zeros((len(sets), BUCKETS), np.float32)
    for k, s in enumerate(sets):
        m[k, s] = 1 / np.sqrt(max(len(s), 1))
    return m


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        fit_docs: int = 800, landmarks: int = 64, ridge: float = 0.05, max_labels: int = 40) -> Model | None:
    """Learn from about ``fit_docs`` texts of each language, ``landmarks`` of each as landmarks.

    Learned are the ``max_labels`` languages with most texts (of equals the one that sorts first); others, such as the stray
    values of a dirty column, are not. The three bounds fix what reaches the
    driver and the size of the system solved there; the texts are chosen by a hash of their key, all of a language that
    has fewer. Rows without text or letters teach nothing. None if nothing is left.
    """
    ship(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.lit(9)), F.lit(1 << 30)).alias("draw"))
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_labels)
    totals = {r["lang"]: r["count"] for r in most.collect()}
    if not totals:
        return None
    names = sorted(totals)
    share = lambda bound: F.create_map(*[
        F.lit(x) for n in names for x in (n, int(min(1.0, bound / totals[n]) * (1 << 30)))])[F.col("lang")]
    held = rows.where(F.col("draw") < share(landmarks)).select("text")
    marks = [s for r in append_columns(held, ["text"], "grams binary", _packed, drop=("text",)).collect()
             if len(s := np.frombuffer(r.grams, np.uint16).astype(np.int64))]
    if not marks:
        return None
    base = _rows(marks)
    value, vector = np.linalg.eigh((base @ base.T).astype(float))
    root = vector * (np.clip(value, 0, None) + 1e-6) ** -0.5  # K^-1/2 up to a rotation
    m, c = len(marks), len(names)

    # the sample is bounded, and so are its few tasks' sums, which come to the driver
    found = (rows.where(F.col("draw") < share(fit_docs)).select("text", "lang").repartition(6)
             .mapInArrow(_sums(marks, root, names), "gram binary, cross binary").collect())
    gram = sum(np.frombuffer(r.gram).reshape(m, m) for r in found)
    cross = sum(np.frombuffer(r.cross).reshape(m, c) for r in found)
    learned = np.linalg.solve(gram + ridge * np.eye(m), cross)
    return Model(names, (base.T.astype(float) @ (root @ learned)).astype(np.float32))


def _sums(marks: list[np.ndarray], root: np.ndarray, names: list[str]):
    """What a task adds up over its texts: the products of their features with each other and with their languages.

    Landmarks travel as buckets and become rows in the task: the matrix is some hundred times as large, and
    sent with the function it would stay in each executor and worker, twice.
    """
    grams = [s.astype(np.uint16).tobytes() for s in marks]

    def sums(batches):
        base = _rows([np.frombuffer(g, np.uint16).astype(np.int64) for g in grams])
        m, c = len(grams), len(names)
        gram, cross = np.zeros((m, m)), np.zeros((m, c))
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128).to_pydict()
                sets = [ngrams(t) for t in part["text"]]
                phi = (_rows(sets) @ base.T).astype(float) @ root
                phi *= np.array([len(s) > 0 for s in sets])[:, None]
                gram += phi.T @ phi
                cross += phi.T @ (np.array(part["lang"])[:, None] == np.array(names)[None, :])
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()], "cross": [cross.tobytes()]})

    return sums


def _packed(texts):
    return [[ngrams(t).astype(np.uint16).tobytes() for t in texts]]


def score(sets: list[np.ndarray], model: Model) -> np.ndarray:
    """Texts by languages: the product of the texts' presence rows with the model, row by row scaled."""
    out = np.zeros((len(sets), len(model.languages)))
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        sizes = np.array([len(sets[k]) for k in full])
        rows = model.weights[np.concatenate([sets[k] for k in full])]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        out[full] = np.add.reduceat(rows, starts, axis=0, dtype=float) / np.sqrt(sizes)[:, None]
    return out


def identify(docs: DataFrame, model: Model | None, text: str = "text", prefix: str = "") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to each row; both replace columns of that name.

    ``prefix`` goes before both names, for tables that have such columns to keep.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    everything if there is no model. Equal scores: the language that sorts
    first. Predictions see the text alone. Repeated rows and empty tables are fine.
    """
    def run(texts):
        if model is None:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        names, values = [], []
        for at in range(0, len(texts), 64):
            sets = [ngrams(t) for t in texts[at:at + 64]]
            found = score(sets, model)
            best = found.argmax(axis=1)
            for s, k, row in zip(sets, best, found):
                names.append(model.languages[k] if len(s) else UNKNOWN)
                values.append(float(np.clip(row[k], 0, 1)) if len(s) else 0.0)
        return [names, values]

    return append_columns(docs, [text], f"`{prefix}lang_pred` string, `{prefix}score` double", run)


def held_out(key: str = "doc_id"):
    """Documents from which nothing is learned: crc32 of the id modulo 4 is 2 (false without an id)."""
    return F.coalesce(crc32_of_id(key) % 4 == 2, F.lit(False))


def fit_production(docs: DataFrame) -> Model | None:
    return fit(docs.where(~held_out() & F.col("doc_id").isNotNull()))


def query(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit_production(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
