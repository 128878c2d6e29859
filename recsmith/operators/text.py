"""Title text features (P15 TF-IDF, P16 truncated SVD) as DataFrame jobs.

TF-IDF follows the reference's vectorizer: lower-case, tokens of two or more
word characters, stop words removed, the ``max_features`` most frequent terms
(ties by term), idf = ln((1 + n) / (1 + df)) + 1, rows L2-normalised.  The
matrix is kept sparse and long: (doc, term, col, weight).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.session import materialize

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"  # runs of two or more word characters of any script


def default_stop_words() -> list[str]:
    """Spark's English stop-word list (the reference's list is a different one: a parameter)."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(df: DataFrame, text_col: str, stop_words: list[str] | None = None) -> DataFrame:
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(stop, t))
    return df.withColumn("_tokens", toks)


def _vocabulary(docs: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms, ties by term, as ``(term, col)``: a top-k report of at most ``max_features`` rows.  A batch's terms are
    counted before they become rows."""
    def count(batches):
        for batch in batches:
            met = pc.value_counts(batch.column("_tokens").flatten().cast(pa.string()))
            yield pa.RecordBatch.from_arrays([met.field("values"), met.field("counts")], names=["term", "n"])

    vocab = (docs.select("_tokens").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("total"))
             .orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features))
    return materialize(vocab.select("term", (F.row_number().over(Window.orderBy("term")) - 1).cast("long").alias("col")))


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values))


def _counted(docs: DataFrame, id_col: str, terms: list[str]) -> DataFrame:
    """``(id, cols, tfs)``: a row's vocabulary terms and how often each occurs, counted where the row lies; nothing is shuffled.
    Written once."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            tokens = batch.column("_tokens")
            col = pc.index_in(tokens.flatten().cast(pa.string()), known)
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
            met = pc.is_valid(col).to_numpy(zero_copy_only=False)
            cell = doc[met] * len(known) + col.drop_null().to_numpy()
            cell, tf = np.unique(cell, return_counts=True)
            lengths = np.bincount(cell // max(len(known), 1), minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), _lists(lengths, (cell % max(len(known), 1)).astype(np.int32)),
                                              _lists(lengths, tf.astype(np.int64))], names=[id_col, "cols", "tfs"])

    schema = T.StructType([docs.schema[id_col], T.StructField("cols", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))])
    return materialize(docs.select(id_col, "_tokens").mapInArrow(count, schema))


def _merged(counted: DataFrame, id_col: str) -> DataFrame:
    """``(id, n, cols, tfs)``, a row an id of ``n`` counted rows.  Only ids of several rows, NULL among them, are shuffled by cell."""
    repeated = counted.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull())
    repeated = materialize(repeated.withColumnRenamed(id_col, "_id"))
    alone = counted.select(id_col, F.lit(1).cast("long").alias("n"), "cols", "tfs")
    if repeated.isEmpty():
        return alone
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    cells = (counted.join(repeated, same).select("_id", F.explode(F.arrays_zip("cols", "tfs")).alias("_c"))
             .groupBy("_id", F.col("_c.cols").alias("col")).agg(F.sum("_c.tfs").alias("tf")))
    lists = cells.groupBy(F.col("_id").alias(id_col)).agg(F.collect_list(F.struct("col", "tf")).alias("_cells"))
    whole = repeated.join(lists, same, "left").select(
        F.col("_id").alias(id_col), "n", F.coalesce(F.col("_cells.col"), F.array().cast("array<int>")).alias("cols"),
        F.coalesce(F.col("_cells.tf"), F.array().cast("array<bigint>")).alias("tfs"))
    return materialize(alone.join(repeated.select("_id"), same, "left_anti").unionByName(whole))


def tfidf_rows(df: DataFrame, id_col: str, text_col: str, max_features: int = 100,
               stop_words: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """P15 as one row an id, ``(id, n, cols, weights)``, and the vocabulary ``(term, col)``; an id of ``n`` rows has each of its cells once.

    The vocabulary depends on the terms' totals alone, so it is found first, and only its terms are counted.  A document is one row, so its
    counts and its length need no shuffle; the document frequencies are one aggregate by term."""
    stop = default_stop_words() if stop_words is None else stop_words
    docs = tokens(df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text")), "_text", stop)
    n_docs = df.count()
    vocab = _vocabulary(docs, max_features)
    terms = [r.term for r in vocab.orderBy("col").collect()]  # at most max_features
    rows = _merged(_counted(docs, id_col, terms), id_col)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    known = rows.select(F.explode("cols").alias("col")).groupBy("col").agg(F.count(F.lit(1)).alias("df")).select("col", idf.alias("idf")).toPandas()
    each = np.zeros(len(terms))  # at most max_features numbers
    each[known["col"].to_numpy(dtype=np.int64)] = known["idf"].to_numpy()
    shared = df.sparkSession.sparkContext.broadcast(each)

    def weigh(batches):
        for batch in batches:
            unknown = pc.is_null(batch.column(id_col)).to_numpy(zero_copy_only=False)  # NULL is nobody's id: counted above, without cells
            lengths = pc.list_value_length(batch.column("cols")).to_numpy(zero_copy_only=False).astype(np.int64)
            cols, tfs = batch.column("cols").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), lengths)
            raw = tfs * shared.value[cols]
            weights = raw / np.sqrt(np.bincount(doc, weights=raw * raw, minlength=batch.num_rows))[doc]
            kept = ~unknown[doc]
            lengths = np.where(unknown, 0, lengths)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("n"), _lists(lengths, cols[kept]), _lists(lengths, weights[kept])],
                                             names=[id_col, "n", "cols", "weights"])

    schema = T.StructType([df.schema[id_col], T.StructField("n", T.LongType()), T.StructField("cols", T.ArrayType(T.IntegerType())),
                           T.StructField("weights", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(weigh, schema), vocab


def tfidf(df: DataFrame, id_col: str, text_col: str, max_features: int = 100,
          stop_words: list[str] | None = None) -> DataFrame:
    """Long sparse TF-IDF ``(id, term, col, weight)``; ``col`` is the term's
    position in the alphabetically sorted vocabulary.  The long form of ``tfidf_rows``: a row of ``df`` each of its id's cells."""
    rows, vocab = tfidf_rows(df, id_col, text_col, max_features, stop_words)
    rows = rows.select(id_col, "cols", "weights", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_row"))
    # a document without any vocabulary term keeps a row: term and col NULL, weight 0
    cells = rows.select(id_col, F.explode_outer(F.arrays_zip("cols", "weights")).alias("_c"))
    cells = cells.select(id_col, F.col("_c.cols").cast("long").alias("col"), F.coalesce("_c.weights", F.lit(0.0)).alias("weight"))
    return cells.join(F.broadcast(vocab), "col", "left").select(id_col, "term", "col", "weight")


#: The first block of the subspace: a vocabulary of no more terms is spanned by it, and one pass is exact.
FIRST_BLOCK = 128
#: Documents and their cells multiplied at a time in a task, as a dense block over the terms they hold: at most about 64 x 4,096 numbers,
#: which stay in a core's cache (a longer document is taken whole).
DOCUMENTS, CELLS = 64, 4_096


def sparse_rows(long: DataFrame, id_col: str) -> DataFrame:
    """The long table as one row a document, ``(id, n, cols, weights)``; cells that repeat add up.  Written once, since every pass
    reads it."""
    cells = F.collect_list(F.when(F.col("col").isNotNull(), F.struct("col", "weight")))
    rows = long.groupBy(id_col).agg(cells.alias("_cells"))
    return materialize(rows.select(id_col, F.lit(1).cast("long").alias("n"), F.col("_cells.col").alias("cols"), F.col("_cells.weight").alias("weights")))


def _blocks(batch, size: int):
    """A batch in blocks of whole documents, over the terms that these hold: (documents with cells, terms, cells' places in the block, their
    weights).  A row that counts ``n`` times has n times its weights."""
    lengths = pc.fill_null(pc.list_value_length(batch.column("cols")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cols = batch.column("cols").flatten().to_numpy(zero_copy_only=False)
    weights = batch.column("weights").flatten().to_numpy(zero_copy_only=False)
    weights = weights * np.repeat(batch.column("n").to_numpy(zero_copy_only=False), lengths)
    docs = np.flatnonzero(lengths)
    ends = np.cumsum(lengths)[docs]
    begins = ends - lengths[docs]
    place = np.zeros(size, dtype=np.int64)
    i = 0
    while i < len(docs):
        j = min(i + DOCUMENTS, max(i + 1, int(np.searchsorted(ends, begins[i] + CELLS, side="right"))))
        inside = cols[begins[i]:ends[j - 1]]
        place[inside] = 1
        terms = np.flatnonzero(place)
        place[terms] = np.arange(len(terms))
        cells = np.repeat(np.arange(j - i) * len(terms), lengths[docs[i:j]]) + place[inside]
        place[terms] = 0
        yield docs[i:j], terms, cells, weights[begins[i]:ends[j - 1]]
        i = j


def _dense(documents: int, terms: np.ndarray, cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The block's documents x terms; cells that repeat add up."""
    return np.bincount(cells, weights=weights, minlength=documents * len(terms)).reshape(documents, len(terms))


def _gram_product(rows: DataFrame, size: int, block: np.ndarray) -> np.ndarray:
    """AᵀA·block in one pass over the rows: a task adds up its documents' products, and the tasks' sums are added by term.
    The block and the result have ``size`` x width numbers, whatever the number of documents; there are as many sums as cores."""
    spark, width = rows.sparkSession, block.shape[1]
    shared = spark.sparkContext.broadcast(block)

    def products(batches):
        v, total, met = shared.value, np.zeros((size, width)), np.zeros(size, dtype=bool)
        for batch in batches:
            for docs, terms, cells, weights in _blocks(batch, size):
                part = _dense(len(docs), terms, cells, weights)
                total[terms] += part.T @ (part @ v[terms])
                met[terms] = True
        terms = np.flatnonzero(met)
        for i in range(0, len(terms), 4096):
            part = terms[i:i + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(total[part, j]) for j in range(width)]],
                                             names=["col", *[f"y{j}" for j in range(width)]])

    names = [f"y{j}" for j in range(width)]
    sums = (rows.select("n", "cols", "weights").coalesce(spark.sparkContext.defaultParallelism)
            .mapInArrow(products, "col long, " + ", ".join(f"{n} double" for n in names))
            .groupBy("col").agg(*[F.sum(n).alias(n) for n in names])).toPandas()  # at most size x width numbers
    shared.unpersist()
    out = np.zeros((size, width))
    out[sums["col"].to_numpy(dtype=np.int64)] = sums[names].to_numpy()
    return out


def right_factors(rows: DataFrame, size: int, k: int, tolerance: float = 1e-10, max_passes: int = 200) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` leading eigenpairs of AᵀA by block subspace iteration: ``(values, vectors, passes)``.

    The subspace grows by the residuals of the pairs that are still open, one pass over the rows each time, and is cut back
    to its leading pairs when it is wide.  It ends when every residual is within ``tolerance`` of the largest value, and raises if
    ``max_passes`` do not suffice.  The driver holds ``size`` x width numbers.  Each vector's largest entry is positive."""
    k = min(k, size)
    width = min(size, max(FIRST_BLOCK, 2 * k))
    widest, kept = width + 8 * k, width // 2 + k
    new = np.linalg.qr(np.random.default_rng(0).standard_normal((size, width)))[0]
    basis, image = np.zeros((size, 0)), np.zeros((size, 0))
    for passes in range(1, max_passes + 1):
        image = np.hstack([image, _gram_product(rows, size, new)])
        basis = np.hstack([basis, new])
        small = basis.T @ image
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        vectors = basis @ mix[:, :k]
        rest = image @ mix[:, :k] - vectors * values[:k]
        missing = np.linalg.norm(rest, axis=0)
        still = missing > tolerance * max(values[0], 0.0)
        if not still.any() or basis.shape[1] == size:
            top = np.abs(vectors).argmax(axis=0)
            return np.clip(values[:k], 0.0, None), vectors * np.where(vectors[top, range(k)] < 0, -1.0, 1.0), passes
        if basis.shape[1] + k > widest:
            basis, image = basis @ mix[:, :kept], image @ mix[:, :kept]
        new = rest[:, still] / missing[still]
        for _ in range(2):
            new = new - basis @ (basis.T @ new)
            left, s, _ = np.linalg.svd(new, full_matrices=False)
            new = left[:, s > 1e-8 * s[0]][:, :size - basis.shape[1]]
    raise RuntimeError(f"the subspace has not settled within {max_passes} passes")


def truncated_svd(matrix: DataFrame, id_col: str, size: int, k: int = 20) -> tuple[DataFrame, list[float]]:
    """Rank-k SVD of the (uncentred) TF-IDF matrix; returns (id, svd_0..svd_{k-1}) = U·S and the singular values.

    ``matrix`` is the long table, or the rows of ``tfidf_rows``, which every pass reads: the caller has them written.
    The right factor comes from ``right_factors``, and the projection A·V is one more pass, a document at a time.  No document meets
    itself in a join, so a row costs its cells, not their square.  Documents without terms have all components 0."""
    rows = matrix if "cols" in matrix.columns else sparse_rows(matrix, id_col)
    values, vectors, _ = right_factors(rows, size, k)
    shared, width = rows.sparkSession.sparkContext.broadcast(vectors), vectors.shape[1]
    names = [f"svd_{j}" for j in range(width)]

    def project(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, width))
            for docs, terms, cells, weights in _blocks(batch, size):
                out[docs] = _dense(len(docs), terms, cells, weights) @ shared.value[terms]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *[pa.array(out[:, j]) for j in range(width)]], names=[id_col, *names])

    schema = T.StructType([matrix.schema[id_col], *[T.StructField(n, T.DoubleType()) for n in names]])
    return rows.mapInArrow(project, schema), [float(x) for x in np.sqrt(values)]
