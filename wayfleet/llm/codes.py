"""Compression of vectors into codes of parts, with per-dimension value dictionaries.

Components become integers. Vectors are written once as blocks of bounded size: a
block has, for each dimension, the sorted distinct integers of its vectors and every
vector's place in that list. To compare a part with its codebook, the squared
differences of each distinct integer to all entries are tabulated once a dimension,
and a vector's distances are the sums of the rows its places point at. A round reads
the blocks and adds up, for each part and entry, the count and the components of the
vectors nearest to it; tasks add up their own blocks first, so as many numbers as the
codebooks have come to the driver, whatever the size of the table.

Defined results: vectors that are null or hold a null, NaN or infinite component take
no part; vectors of different dimensions have codebooks of their own; part i of p holds the
dimensions from i * d // p to (i + 1) * d // p; fewer vectors than entries make a smaller
codebook; the first codebook follows the ids, nulls last, equal ids by their vectors;
rows of one id are coded each; rows without a label form one group; further columns
are ignored. Integers so large that squared distances might leave 64 bits raise an error.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm import text
from wayfleet.session import cut

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CELLS = 1 << 20         # components of a block

Books = dict[int, list[np.ndarray]]


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, x) of the vectors that are whole and finite."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), x.alias("x"))
    return rows.where("x is not null and not exists(x, c -> c is null or isnan(c) or abs(c) = double('infinity'))").select(
        "id", "label", F.size("x").alias("dim"), "x")


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; refuses values whose squared differences might not fit."""
    made = np.floor(np.float64(scale) * x)
    if made.size and np.abs(made).max() >= np.sqrt(2.0 ** 60 / x.shape[-1]):
        raise ValueError("components are too large for exact squared distances in 64 bits")
    return made.astype(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(edges, pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _block(dim: int, ids: pa.Array, labels: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    values, places = [], np.zeros((dim, len(x)), np.int32)
    for d in range(dim):
        own, places[d] = np.unique(x[:, d], return_inverse=True)
        values.append(own)
    one = lambda array: pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
    listed = _lists(values)
    listed = pa.ListArray.from_arrays(pa.array([0, dim], pa.int32()), listed)
    return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), one(ids), one(labels), listed, pa.array([places.tobytes()], pa.binary())],
                                      ["dim", "ids", "labels", "values", "places"])


@text.tidied
def _blocks(scale: int, batches):
    """Rows of one dimension gathered into blocks of about ``CELLS`` components."""
    held: dict[int, list[pa.RecordBatch]] = {}

    def made(dim):
        table = pa.Table.from_batches(held.pop(dim)).combine_chunks()
        x = table.column("x").combine_chunks() if table.num_rows else None
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)
        return _block(dim, table.column("id").combine_chunks(), table.column("label").combine_chunks(), integers(x, scale))

    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch.filter(pa.array(dims == dim))
            most = max(1, CELLS // max(dim, 1))
            for start in range(0, own.num_rows, most):
                part = own.slice(start, most)
                if sum(b.num_rows for b in held.get(dim, [])) + part.num_rows > most:
                    yield made(dim)
                held.setdefault(dim, []).append(part)
    for dim in list(held):
        yield made(dim)


def _parts(dim: int, parts: int) -> list[range]:
    return [range(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def _nearest(values: list[np.ndarray], places: np.ndarray, dims: range, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of one part of each vector: rows of the tables of its dimensions, gathered and added."""
    far = np.zeros((places.shape[1], len(book)), np.int64)
    for k, d in enumerate(dims):
        table = (values[d][:, None] - book[None, :, k]) ** 2
        far += table[places[d]]
    best = far.argmin(axis=1)
    return best, far[np.arange(len(best)), best]


def _read(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        dim = batch.column("dim")[i].as_py()
        values = [np.array(v.values.to_numpy(zero_copy_only=False), np.int64) for v in batch.column("values")[i].values] if dim else []
        ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
        places = np.frombuffer(batch.column("places")[i].as_py(), np.int32).reshape(dim, len(ids)) if dim else np.zeros((0, len(ids)), np.int32)
        yield dim, ids, labels, values, places


@text.tidied
def _sums(books: Books, batches):
    """Of a task's blocks: for each part and entry the count (at -1) and the sums of the components."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for dim, _, _, values, places in _read(batch):
            for p, (dims, book) in enumerate(zip(_parts(dim, len(books[dim])), books[dim])):
                best, _ = _nearest(values, places, dims, book)
                own = np.zeros((len(book), len(dims) + 1), np.int64)
                own[:, 0] = np.bincount(best, minlength=len(book))
                order = np.argsort(best, kind="stable")
                first = np.searchsorted(best[order], np.arange(len(book)))
                used = own[:, 0] > 0
                for k, d in enumerate(dims):
                    own[used, k + 1] = np.add.reduceat(values[d][places[d][order]], first[used])
                total[dim, p] = total.get((dim, p), 0) + own
    rows = [(dim, p, e, k - 1, int(own[e, k])) for (dim, p), own in total.items() for e in range(len(own)) for k in range(own.shape[1])]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i < 4 else pa.int64()) for i in range(5)],
                                     ["dim", "part", "entry", "at", "total"])


@text.tidied
def _coded(books: Books, digests: dict[int, str], batches):
    for batch in batches:
        for dim, ids, labels, values, places in _read(batch):
            found = [_nearest(values, places, dims, book) for dims, book in zip(_parts(dim, len(books[dim])), books[dim])]
            error = sum((far for _, far in found), np.zeros(len(ids), np.int64))
            codes = [bytes(c).hex() for c in np.stack([best for best, _ in found], axis=1).astype(np.uint8)] if len(ids) else []
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error), pa.array([digests[dim]] * len(ids), pa.string())],
                                             ["id", "label", "code", "error", "codebooks_sha256"])


def first_books(rows: DataFrame, scale: int, parts: int, entries: int) -> Books:
    """The codebooks before the first round: the parts of the vectors of the smallest ids. As many rows as entries are read."""
    books: Books = {}
    for dim in sorted(r["dim"] for r in rows.select("dim").distinct().collect()):
        chosen = rows.where(F.col("dim") == dim).orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
        x = integers(np.array([r["x"] for r in chosen], np.float64).reshape(len(chosen), dim), scale)
        books[dim] = [x[:, list(own)].reshape(len(chosen), -1) for own in _parts(dim, parts)]
    return books


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(c)) for book in books for entry in book for c in entry).encode()).hexdigest()


def train_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(blocks, codebooks by dimension): the written dictionary blocks and what the rounds made of the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of a part is one byte")
    rows = taking_part(vectors, id_col, vector_col, label_col)
    types = [vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)]
    blocks = cut(rows.mapInArrow(functools.partial(_blocks, scale), f"dim int, ids array<{types[0]}>, labels array<{types[1]}>, "
                                 "values array<array<long>>, places binary"), "blocks")
    books = first_books(rows, scale, parts, entries)
    for _ in range(rounds if books else 0):
        made = blocks.mapInArrow(functools.partial(_sums, books), "dim int, part int, entry int, at int, total long")
        total = {(r["dim"], r["part"], r["entry"], r["at"]): r["total"]
                 for r in made.groupBy("dim", "part", "entry", "at").agg(F.sum("total").alias("total")).collect()}
        fresh = {dim: [book.copy() for book in own] for dim, own in books.items()}
        for (dim, part, entry, at), x in total.items():
            count = total[dim, part, entry, -1]
            if at >= 0 and count:
                fresh[dim][part][entry, at] = x // count
        books = fresh
    return blocks, books


def encode_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                   parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every vector that takes part; see the module."""
    blocks, books = train_codes(vectors, id_col, vector_col, label_col, scale, parts, entries, rounds)
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    digests = {dim: codebook_digest(own) for dim, own in books.items()}
    coded = cut(blocks.mapInArrow(functools.partial(_coded, books, digests),
                                  f"id {kinds[id_col]}, label {kinds[label_col]}, code string, error long, codebooks_sha256 string"), "codes")
    sums = cut(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias(id_col), "code", "error", "label_error", "codebooks_sha256")
