"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Trusted documents (labelled of good quality and not toxic) are halved by a hash of their id. One
half is counted as raw 4-grams of characters, per language; the other sets the threshold. Counts,
discounted shares and context weights are tables keyed by (model, gram) and (model, context), and
the orders are interpolated by joins on them. Documents are dealt into chunks as they are read; a
chunk keeps its rows packed in one compressed value and asks for its distinct grams once, the
requests are joined with the probabilities, and what comes back meets the chunk's rows again. Every
table grows with the text, and none is collected or broadcast but those with one row per language. A document is rejected if its rate, in bits a symbol, is above its
language's limit: the QUANTILE of the held-out trusted documents' rates and half the distance
between their quartiles above it.

Defined cases: a NULL or empty text has no perplexity and is not kept. Every language with
MIN_TRUSTED trusted documents has its own model and threshold, however many languages there are;
the others, and NULL, take both from all trusted text together. A document labelled twice counts
with its lowest quality and highest toxicity. Without held-out trusted documents nothing can be
judged and every text that is not empty is kept. A very long text is a chunk of its own. An empty
table gives an empty result. Repeated rows are judged row by row, and in
training they count as often as they occur. Extra columns are carried along and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from usageledger.llm.common import small_batches, stored, stored_at
from usageledger.session import scratch_path
from usageledger.sinks.files import drop_folder

# Raw grams of the classifier: so many characters, unfolded.
LENGTH = 4
CODE_POINTS = 0x110000
# Documents that ask together for the probabilities of their grams, and their bytes.
CHUNK_DOCS = 4_000
CHUNK_BYTES = 16_000_000
# Chunks of held-out documents that the pooled model judges are numbered from here on.
HELD_CHUNKS = 1 << 60
# Chunks meet their answers in so many passes, one after another: a pass's shuffle is deleted before the next.
PASSES = 4
# Tables of gram hashes have so many bits of slots.
TABLE_BITS = 20
_MIX = np.random.RandomState(7).randint(1, 2**63 - 1, LENGTH, dtype=np.int64).astype(np.uint64) | np.uint64(1)
# Languages with so many trusted documents have their own models; the others share one.
MIN_TRUSTED = 20
POOLED = ""
# The share of held-out trusted documents whose rate lies below their language's limit.
QUANTILE = 0.99
# A text is judged as if it went on for so many average characters: short ones vary more.
PRIOR_CHARS = 100
# A task adds up the grams of so many characters at a time.
FLUSH_CHARS = 2_000_000


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents labelled good and not toxic, once each."""
    per_doc = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("doc_id"))
    both = per_doc.agg(F.min(labels["quality"]).alias("quality"), F.max(labels["toxic"]).alias("toxic"))
    return both.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")


def _discounted(counts: DataFrame, ctx: Column) -> tuple[DataFrame, DataFrame]:
    """Modified Kneser-Ney of one order: (lang, gram, share) and (lang, ctx, weight)."""
    keyed = counts.withColumn("ctx", ctx)
    how_many = lambda k: F.sum((F.col("n") == k).cast("long"))
    spectrum = keyed.groupBy("lang").agg(*[how_many(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1").cast("double"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        raw = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}").cast("double"), F.col(f"n{k}"))
        # Where a count does not occur the estimate is undefined; a half of the count is safe.
        return F.least(F.greatest(F.coalesce(raw, F.lit(0.5 * k)), F.lit(0.1 * k)), F.lit(0.9 * k))

    discounts = spectrum.select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
    contexts = keyed.groupBy("lang", "ctx").agg(
        F.sum("n").alias("total"), how_many(1).alias("c1"), how_many(2).alias("c2"), F.sum((F.col("n") > 2).cast("long")).alias("c3")
    )
    # One row per language: as many as there are models.
    contexts = contexts.join(F.broadcast(discounts), "lang")
    weight = (F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * F.col("c3")) / F.col("total")
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    shares = keyed.join(contexts, ["lang", "ctx"]).select("lang", "gram", ((F.col("n") - off) / F.col("total")).alias("share"))
    return shares, contexts.select("lang", "ctx", weight.alias("weight"))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the raw gram that ends at each character and end of the texts; starts; code points."""
    joined = "".join(f"{' ' * (LENGTH - 1)}{t} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(t) + LENGTH for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(points), dtype=bool)
    for k in range(1, LENGTH):
        inside[ends - k] = False
    starts = np.flatnonzero(inside)
    codes = np.zeros(len(starts), dtype=np.uint64)
    for k in range(LENGTH):
        codes += points[starts + k] * _MIX[k]
    return codes, starts, points


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of one occurrence of each code, and how often it occurs: by a table, sorting only what collides."""
    slot = (codes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    last = np.full(1 << TABLE_BITS, -1, dtype=np.int64)
    last[slot] = np.arange(len(codes))
    same = codes[last[slot]] == codes
    counts = np.bincount(slot[same], minlength=1 << TABLE_BITS)
    used = np.flatnonzero(counts)
    first, n = last[used], counts[used]
    rest = np.flatnonzero(~same)
    if len(rest):
        _, at, more = np.unique(codes[rest], return_index=True, return_counts=True)
        first, n = np.concatenate([first, rest[at]]), np.concatenate([n, more])
    return first, n


class _Logs:
    """Looks up the log probabilities of gram hashes: a table, and a sorted array for what collides."""

    def __init__(self, codes: np.ndarray, logs: np.ndarray) -> None:
        slot = self._slot(codes)
        self.codes, self.logs = np.zeros(1 << TABLE_BITS, dtype=np.uint64), np.zeros(1 << TABLE_BITS)
        self.codes[slot], self.logs[slot] = codes, logs
        left = np.flatnonzero(self.codes[slot] != codes)
        order = left[np.argsort(codes[left])]
        self.rest, self.rest_logs = codes[order], logs[order]

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        out = self.logs[slot]
        missed = np.flatnonzero(self.codes[slot] != codes)
        out[missed] = self.rest_logs[np.searchsorted(self.rest, codes[missed])]
        return out


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about FLUSH_CHARS characters at most, or one text."""
    held: list[str] = []
    chars = 0
    for t in texts:
        if held and chars + len(t) > FLUSH_CHARS:
            yield held
            held, chars = [], 0
        held.append(t)
        chars += len(t)
    if held:
        yield held


def _gram_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, code points (one row of LENGTH a gram) and counts of the distinct grams of the texts."""
    parts = []
    for some in _slices(texts):
        codes, starts, points = _codes(some)
        first, n = _distinct(codes)
        parts.append((codes[first], points[starts[first][:, None] + np.arange(LENGTH)[None, :]].astype("<u4"), n))
    if len(parts) == 1:
        return parts[0]
    codes, points, n = (np.concatenate([p[k] for p in parts]) for k in range(3))
    _, first, group = np.unique(codes, return_index=True, return_inverse=True)
    return codes[first], points[first], np.bincount(group, weights=n).astype(np.int64)


def _strings(points: np.ndarray) -> pa.Array:
    flat = points.tobytes().decode("utf-32-le")
    return pa.array([flat[i : i + LENGTH] for i in range(0, len(flat), LENGTH)], pa.string())


def raw_grams(texts: DataFrame) -> DataFrame:
    """(model, gram, n) over (model, text): each gram once per task and flush."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        chars = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for model, found in held.items():
                _, points, n = _gram_rows(found)
                yield pa.RecordBatch.from_arrays([pa.array([model] * len(n), pa.string()), _strings(points), pa.array(n, pa.int64())], ["model", "gram", "n"])
            held.clear()

        for part in parts:
            for model, text in zip(*(part.column(k).to_pylist() for k in range(2)), strict=True):
                held.setdefault(model, []).append(text)
                chars += len(text)
                if chars >= 4 * FLUSH_CHARS:
                    yield from flush()
                    chars = 0
        yield from flush()

    return texts.select("model", "text").mapInArrow(run, "model string, gram string, n long")


def _chunks(rows: DataFrame, text: str, first: int = 0) -> DataFrame:
    """(chunk, model, gram, rows) over (row, model, ...): a chunk is one line with its rows, packed,
    and one line per model and distinct gram of its texts.

    Chunks are what a task reads next to each other, numbered from `first` on; they hold only once written.
    """
    fields = pa.schema([("chunk", pa.int64()), ("model", pa.string()), ("gram", pa.string()), ("rows", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packing = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        held: list[pa.RecordBatch] = []
        size = chars = made = 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = first + (task << 24) + made
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=packing) as out:
                for part in held:
                    out.write_batch(part)
            none = pa.nulls(1, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), none, none, pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=fields)
            texts: dict[str, list[str]] = {}
            for part in held:
                for model, value in zip(part.column("model").to_pylist(), part.column("row").field(text).to_pylist(), strict=True):
                    if value:
                        texts.setdefault(model, []).append(value)
            for model, found in texts.items():
                grams = _strings(_gram_rows(found)[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), chunk)), pa.array([model] * len(grams), pa.string()), grams, pa.nulls(len(grams), pa.binary())], schema=fields)
            held.clear()

        for part in parts:
            if part.num_rows:
                held.append(part)
                size, chars = size + part.num_rows, chars + part.nbytes
            if size >= CHUNK_DOCS or chars >= CHUNK_BYTES:
                yield from flush()
                size, chars, made = 0, 0, made + 1
        if held:
            yield from flush()

    return rows.mapInArrow(run, "chunk long, model string, gram string, rows binary")


def probabilities(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(model, gram, logp) of every wanted gram, from the trusted (model, gram, n).

    Each order's shares and weights are joined with the next lower order by model and context, so
    every table here is rows of Spark that grow with the text.
    """
    tables, needed = [], [wanted]
    counts = counts.withColumnRenamed("model", "lang")
    for order in range(LENGTH, 0, -1):
        tables.append(_discounted(counts, F.substring("gram", 1, order - 1) if order > 1 else F.lit("")))
        if order > 1:
            counts = stored(counts.groupBy("lang", F.substring("gram", 2, order - 1).alias("gram")).agg(F.count("*").alias("n")), "gram-continuations")
            needed.append(needed[-1].select("model", F.substring("gram", 2, order - 1).alias("gram")).distinct())
    out = None
    for order, (shares, weights), rows in zip(range(1, LENGTH + 1), reversed(tables), reversed(needed), strict=True):
        rows = rows.withColumn("ctx", F.substring("gram", 1, order - 1) if order > 1 else F.lit(""))
        weights = weights.withColumnRenamed("lang", "model")
        both = rows.join(shares.withColumnRenamed("lang", "model"), ["model", "gram"], "left")
        # Order 1 has one context per model.
        both = both.join(F.broadcast(weights) if order == 1 else weights, ["model", "ctx"], "left")
        if out is None:
            below = F.lit(1.0 / CODE_POINTS)
        else:
            both = both.withColumn("rest", F.substring("gram", 2, order - 1)).join(out.withColumnsRenamed({"gram": "rest", "p": "below"}), ["model", "rest"])
            below = F.col("below")
        out = both.select("model", "gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * below).alias("p"))
    return out.select("model", "gram", F.log2("p").cast("float").alias("logp"))


def _scored(chunks: DataFrame, found: DataFrame, kinds: StructType, text: str, carried: list[str]) -> DataFrame:
    """The rows of the chunks (chunk, rows), as `kinds` with only the `carried` columns of row, with
    bits and symbols by their chunk's (model, gram, logp)."""
    inner = {f.name: f for f in kinds["row"].dataType.fields}
    row = StructField("row", StructType([inner[c] for c in carried]), False)
    out = StructType([row, *[f for f in kinds.fields if f.name != "row"], StructField("bits", DoubleType()), StructField("symbols", LongType())])
    schema = to_arrow_schema(out)

    def score(packed: pa.Table, grams_of: pa.Table) -> pa.Table:
        models = np.array(grams_of.column("model").to_pylist(), dtype=object)
        strings, logs = grams_of.column("gram").to_pylist(), grams_of.column("logp").to_numpy().astype(np.float64)
        tables = {}
        for model in set(models.tolist()):
            mine = np.flatnonzero(models == model)
            joined = np.frombuffer("".join(strings[i] for i in mine).encode("utf-32-le"), dtype="<u4").astype(np.uint64).reshape(-1, LENGTH)
            tables[model] = _Logs((joined * _MIX[None, :]).sum(axis=1, dtype=np.uint64), logs[mine])

        def measured(part: pa.RecordBatch) -> pa.RecordBatch:
            bits, symbols = np.full(part.num_rows, np.nan), np.zeros(part.num_rows, dtype=np.int64)
            places: dict[str, list[int]] = {}
            texts = part.column("row").field(text).to_pylist()
            for i, (model, value) in enumerate(zip(part.column("model").to_pylist(), texts, strict=True)):
                if value and model in tables:
                    places.setdefault(model, []).append(i)
            for model, at in places.items():
                done = 0
                for some in _slices([texts[i] for i in at]):
                    sizes = np.array([len(t) + 1 for t in some])
                    sums = np.add.reduceat(tables[model](_codes(some)[0]), np.cumsum(sizes) - sizes)
                    mine = at[done : done + len(some)]
                    bits[mine], symbols[mine] = -sums, sizes
                    done += len(some)
            rows = part.column("row")
            kept = pa.StructArray.from_arrays([rows.field(c) for c in carried], fields=list(schema.field("row").type))
            rest = [part.column(f.name) for f in kinds.fields if f.name != "row"]
            return pa.RecordBatch.from_arrays([kept, *rest, pa.array(bits, mask=symbols == 0), pa.array(symbols)], names=out.names)

        batches = [measured(part) for one in packed.column("rows").to_pylist() for part in pa.ipc.open_stream(one)]
        return pa.Table.from_batches(batches) if batches else schema.empty_table()

    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(score, out)


def limits(rates: DataFrame) -> DataFrame:
    """(model, middle, limit) in bits a symbol: one row per model, from (model, rate) of held-out trusted documents.

    Exact to a thousandth of a bit and the same in every run.
    """
    q = F.percentile(F.floor(F.col("rate") * 1000) / 1000, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75, QUANTILE)]))
    quantiles = rates.groupBy("model").agg(q.alias("q"))
    # Of a dozen held-out documents the quantile is about the largest rate; others lie above it.
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit(0.01))
    return quantiles.select("model", F.col("q")[1].alias("middle"), (F.col("q")[3] + spread / 2).alias("limit"))


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """Every document as `row`, of the columns to `carry` (all), with its perplexity, threshold and `kept`."""
    spark = docs.sparkSession
    small_batches(spark)
    carry = docs.columns if carry is None else carry
    trusted = stored(trusted_ids(labels).withColumnRenamed("doc_id", "score_id"), "gram-trusted").hint("merge")
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].cast("long").alias("score_id"), docs[lang].alias("lang"))
    learns = F.pmod(F.xxhash64("score_id"), F.lit(2)) == 0
    texts = docs.select(docs[doc_id].cast("long").alias("score_id"), docs[lang].alias("lang"), docs[text].alias("text")).where(F.length("text") > 0)
    # One row per language.
    own = texts.select("score_id", "lang").where(F.col("lang").isNotNull()).join(trusted, "score_id", "left_semi")
    own = stored(own.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_TRUSTED).select("lang", F.col("lang").alias("model")), "gram-models")

    def modelled(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(own), "lang", "left").withColumn("model", F.coalesce("model", F.lit(POOLED)))

    # Only this half of the texts is shuffled, once, to meet the trusted ids, which grow with the corpus.
    learned = modelled(texts.where(learns).join(trusted, "score_id", "left_semi"))
    counted = raw_grams(learned).groupBy("model", "gram").agg(F.sum("n").alias("n"))
    rows = modelled(named).select("row", "score_id", "model")
    counts_path, chunk_path = scratch_path(spark, "gram-counts"), scratch_path(spark, "gram-chunks")
    # The shuffle of the learned texts is gone before the chunks are written.
    counts = stored_at(counted, counts_path)
    chunks = stored_at(_chunks(rows, text), chunk_path)
    requests = chunks.where(F.col("rows").isNull()).select("chunk", "model", "gram")
    packed = chunks.where(F.col("rows").isNotNull()).select("chunk", "rows")
    held_rows = None
    # The model of all trusted text is made if a document needs it.
    if not modelled(texts.select("lang")).where(F.col("model") == POOLED).isEmpty():
        pooled = counts.where(F.col("model") != POOLED).withColumn("model", F.lit(POOLED))
        counts = counts.unionByName(pooled).groupBy("model", "gram").agg(F.sum("n").alias("n"))
        held = modelled(texts.where(~learns).join(trusted, "score_id", "left_semi")).where(F.col("model") != POOLED)
        held_rows = held.select(F.struct(F.col("text").alias(text)).alias("row"), "score_id", F.lit(POOLED).alias("model"))
        held_chunks = stored(_chunks(held_rows, text, HELD_CHUNKS), "gram-held")
        requests = requests.unionByName(held_chunks.where(F.col("rows").isNull()).select("chunk", "model", "gram"))
    known = probabilities(counts, stored(requests.select("model", "gram").distinct(), "gram-wanted"))
    found = stored(requests.join(known, ["model", "gram"]).select("chunk", "model", "gram", "logp"), "gram-found")
    drop_folder(spark, counts_path)
    places = [scratch_path(spark, "gram-scores") for _ in range(PASSES)]
    for k, place in enumerate(places):
        turn = F.pmod(F.xxhash64("chunk"), F.lit(PASSES)) == k
        scores = stored_at(_scored(packed.where(turn), found.where(turn & (F.col("chunk") < HELD_CHUNKS)), rows.schema, text, carry), place)
    flat = spark.read.schema(scores.schema).parquet(*places)
    drop_folder(spark, chunk_path)
    rate = (F.col("bits") / F.col("symbols")).alias("rate")
    scored = flat.where(~learns & F.col("bits").isNotNull()).select("score_id", "model", rate).join(trusted, "score_id", "left_semi").select("model", "rate")
    if held_rows is not None:
        again = _scored(held_chunks.where(F.col("rows").isNotNull()).select("chunk", "rows"), found.where(F.col("chunk") >= HELD_CHUNKS), held_rows.schema, text, [text])
        scored = scored.unionByName(again.where(F.col("bits").isNotNull()).select("model", rate))
    bounds = stored(limits(scored), "gram-limits")
    nothing = bounds.isEmpty()
    # One row per model.
    known_limits = flat.join(F.broadcast(bounds), "model", "left")
    shrunk = (F.col("bits") + PRIOR_CHARS * F.col("middle")) / (F.col("symbols") + PRIOR_CHARS)
    kept = F.col("symbols") > 0 if nothing else F.col("bits").isNotNull() & F.coalesce(shrunk <= F.col("limit"), F.col("limit").isNull())
    return known_limits.select(
        "row", "bits", "symbols",
        F.when(F.lit(not nothing), F.pow(F.lit(2.0), F.col("bits") / F.col("symbols"))).alias("perplexity"),
        F.pow(F.lit(2.0), F.col("limit")).alias("threshold"), F.coalesce(kept, F.lit(False)).alias("kept"),
    )
