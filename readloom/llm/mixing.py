"""Mixing sources to target weights (problem 7).

A low-discrepancy source schedule. The whole mix is divided into slots of equal tokens; slot i is the golden
ratio's point frac((i + 1) * phi) mapped through the cumulative weights, so every stretch of slots holds the
sources close to their shares. The slots of a source are ranked; its posts, shuffled by a hash, are cut into
blocks of equal tokens; slot rank r takes block r modulo the number of blocks, in pass r div that number, as
long as the source's cap of passes allows. Ranks and token sums run within bounded chunks, whose totals
are summed first, so no source, however large, is ever in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.seqs import bare
from readloom.session import cut

#: Tokens of a block and of a slot.
BLOCK_TOKENS = 2048
#: Posts, or slots, of a chunk in which sums run.
CHUNK_ROWS = 100_000
#: Largest vocabulary file that is sent to the tasks.
VOCABULARY_MB = 64
_PHI = (math.sqrt(5) - 1) / 2


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _encoding(vocabulary: bytes, pattern: str):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _token_counts(vocabulary, pattern: str):
    kept: list = []

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not kept:
                kept.append(_encoding(vocabulary.value, pattern))
            texts = [t or "" for t in batch.column(2).to_pylist()]
            n = [len(x) for x in kept[0].encode_ordinary_batch(texts, num_threads=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return counts


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens)`` of every post; source trimmed and in lower case, a null text has no tokens.

    The vocabulary file (lines of a token in base64 and its rank) is read where the driver runs and sent to the tasks, as
    executors need not see its path; one beyond ``VOCABULARY_MB`` is an error.
    """
    with open(tokenizer_path or default_tokenizer(), "rb") as f:
        vocabulary = f.read(VOCABULARY_MB * 1_000_000 + 1)
    if len(vocabulary) > VOCABULARY_MB * 1_000_000:
        raise ValueError(f"a vocabulary of more than {VOCABULARY_MB} MB")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(bare("source")).alias("source"), "text")
    counts = _token_counts(docs.sparkSession.sparkContext.broadcast(vocabulary), pattern or default_pattern())
    return rows.mapInArrow(counts, "doc_id bigint, source string, n_tokens bigint")


def _running(df: DataFrame, group: str, chunk: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the group's rows before each: within chunks, plus the totals of the chunks before."""
    sums = df.groupBy(group, chunk).agg(F.sum(value).alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    within = F.coalesce(F.sum(value).over(Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_within", within).join(before, [group, chunk]).withColumn(name, F.col("_within") + F.col("_before")).drop("_within", "_before")


class Mix:
    """The mix of one corpus: ``sizes`` (kept), ``schedule()`` and ``report()``."""

    def __init__(self, docs: DataFrame, targets: DataFrame, *, tokenizer_path: str | None = None, pattern: str | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 7):
        self.spark = docs.sparkSession
        named = targets.where("source is not null").select(F.lower(bare("source")).alias("source"), F.coalesce(F.col("weight"), F.lit(0.0)).cast("decimal(20,12)").alias("weight"), F.coalesce(F.col("max_repeats"), F.lit(1)).alias("max_repeats"))
        self.targets = named.groupBy("source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
        self.sizes = cut(token_counts(docs, tokenizer_path, pattern).join(self.targets.select("source"), "source"))
        self.block_tokens, self.seed = block_tokens, seed
        totals = self.sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("posts"))
        # one row a source of the targets: their number bounds what comes to the driver
        self.sources = [r.asDict() for r in self.targets.join(totals, "source", "left").na.fill(0, ["tokens", "posts"]).orderBy("source").collect()]
        self.tokens = sum(r["tokens"] for r in self.sources)
        self.posts = sum(r["posts"] for r in self.sources)
        self.weights = float(sum(r["weight"] for r in self.sources)) or 1.0
        self.n_slots = round(self.tokens / self.block_tokens)

    def slots(self) -> DataFrame:
        """``(slot, source, rank)``: the scheduled source of each slot, and the number of the source's slots before it."""
        ids = self.spark.range(self.n_slots).withColumnRenamed("id", "slot")
        # the high and the low part of the slot's number apart, so that the fraction stays exact for large numbers
        high, low = F.floor(F.col("slot") / (1 << 20)), F.col("slot") % (1 << 20) + 1
        point = (high * F.lit(math.fmod(_PHI * (1 << 20), 1.0)) + low * F.lit(_PHI)) % 1.0
        upto, source = 0.0, F.lit(self.sources[-1]["source"] if self.sources else None).cast("string")
        bounds = []
        for r in self.sources:
            upto += float(r["weight"]) / self.weights
            bounds.append((upto, r["source"]))
        for bound, name in reversed(bounds[:-1]):
            source = F.when(point < bound, F.lit(name)).otherwise(source)
        slots = ids.select("slot", source.alias("source"), F.floor(F.col("slot") / CHUNK_ROWS).alias("chunk"))
        return _running(slots, "source", "chunk", [F.col("slot")], F.lit(1), "rank").select("slot", "source", "rank")

    def blocks(self) -> DataFrame:
        """``(source, block, doc_id, n_tokens)``: each source's posts in hashed order, cut into blocks of equal tokens."""
        chunks = max(1, math.ceil(self.posts / CHUNK_ROWS))
        h = F.xxhash64(F.lit(self.seed), "doc_id", "n_tokens")
        rows = self.sizes.where("n_tokens > 0").withColumn("h", h).withColumn("chunk", F.floor((F.shiftrightunsigned("h", 11) / float(1 << 53)) * chunks))
        placed = _running(rows, "source", "chunk", [F.col("h"), F.col("doc_id")], F.col("n_tokens"), "start")
        return placed.select("source", F.floor(F.col("start") / self.block_tokens).alias("block"), "doc_id", "n_tokens")

    def filled(self) -> DataFrame:
        """``(slot, source, block, repeat)``: the slots that their source can fill within its cap."""
        ends = F.create_map(*(x for r in self.sources for x in (F.lit(r["source"]), F.lit(math.ceil(r["tokens"] / self.block_tokens))))) if self.sources else F.create_map().cast("map<string,int>")
        cap = F.create_map(*(x for r in self.sources for x in (F.lit(r["source"]), F.lit(r["max_repeats"])))) if self.sources else F.create_map().cast("map<string,int>")
        slots = self.slots().withColumn("n_blocks", F.try_element_at(ends, F.col("source"))).withColumn("cap", F.try_element_at(cap, F.col("source")))
        slots = slots.where((F.col("n_blocks") > 0) & (F.col("rank") < F.col("n_blocks") * F.col("cap")))
        return slots.select("slot", "source", (F.col("rank") % F.col("n_blocks")).alias("block"), F.floor(F.col("rank") / F.col("n_blocks")).alias("repeat"))

    def schedule(self) -> DataFrame:
        """``(doc_id, source, times)``: how often each post is used."""
        uses = self.filled().groupBy("source", "block").agg(F.count("*").alias("times"))
        return self.blocks().join(uses, ["source", "block"]).groupBy("doc_id", "source").agg(F.sum("times").alias("times"))

    def slack(self) -> float:
        """By how many slots a source's share of the schedule may be off its weight, at most.

        n times the discrepancy of the first n golden-ratio points is at most 3 + (1 / ln(phi) + 1 / ln(2)) ln(n); one
        slot more for the rounding of n and of the bounds.
        """
        return 4 + (1 / math.log(1 + _PHI) + 1 / math.log(2)) * math.log(max(self.n_slots, 1))

    def report(self) -> DataFrame:
        """``(source, target_share, tokens, used_tokens, repeats, actual_share, falls_short)``, one row a source of the targets.

        Sources fall short by the schedule: their slots, less what chance may give, are more than their blocks can fill
        within the cap. Those are then held against the exact inequality.
        """
        uses = self.filled().groupBy("source", "block").agg(F.count("*").alias("times"))
        sizes = self.blocks().groupBy("source", "block").agg(F.sum("n_tokens").alias("n"))
        used = sizes.join(uses, ["source", "block"]).groupBy("source").agg(F.sum(F.col("n") * F.col("times")).alias("used_tokens"))
        held = sizes.groupBy("source").agg(F.sum("n").alias("tokens"), F.max("block").alias("last_block"))
        asked = self.slots().groupBy("source").agg((F.max("rank") + 1).alias("slots"))
        out = self.targets.join(held, "source", "left").join(asked, "source", "left").join(used, "source", "left").na.fill(0, ["tokens", "used_tokens", "last_block", "slots"])
        everything = Window.partitionBy(F.lit(1))  # one row a source
        share = F.col("used_tokens") / F.nullif(F.sum("used_tokens").over(everything), F.lit(0))
        # as many whole blocks as lie before the last one are there for sure, each as often as the cap says
        unfilled = F.col("slots") * self.weights + self.slack() * max(1.0, self.weights) > F.col("max_repeats") * F.col("last_block")
        short = unfilled & (F.col("max_repeats") * F.col("tokens") < F.col("weight") * F.lit(self.tokens))
        repeats = F.when(F.col("tokens") > 0, F.col("used_tokens") / F.col("tokens")).otherwise(0.0)
        return out.select("source", F.col("weight").cast("double").alias("target_share"), "tokens", "used_tokens", repeats.alias("repeats"), F.coalesce(share, F.lit(0.0)).alias("actual_share"), short.alias("falls_short"))


def mix_report(docs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """Repeats and actual share of each source, and whether it falls short.

    A source falls short if ``max_repeats`` times its tokens is less than its weight times the tokens of all
    posts whose source is in ``targets``. Sources are compared trimmed and in lower case; posts of other or
    null sources are left out; null and empty texts have no tokens; repeated posts count as often as they
    stand; a target without posts falls short unless its weight is 0; repeated target rows count once.
    """
    return Mix(docs, targets, **options).report()


def mix_schedule(docs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """How often each post is used: ``(doc_id, source, times)``; posts that no slot takes have no row."""
    return Mix(docs, targets, **options).schedule()
