"""Token ids of a whole corpus by a public byte-level BPE tokenizer."""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import settle
from .tables import table

#: Words of byte-level BPE: runs of letters, of digits, of other signs, each with one space before it, and English endings.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text that one block of documents holds, about.
BLOCK_BYTES = 2_000_000
#: Words whose merges one worker replays at a time.
REPLAY_WORDS = 50_000


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file on the machine that asks: each worker finds its own."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(2)
def load_merges(path: str) -> tuple[list[int], dict[tuple[int, int], tuple[int, int]]]:
    """Ids of the 256 single bytes, and of each pair of token ids that merges: (rank, id of the merged token)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab: dict[str, int] = model["vocab"]
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    return [vocab[letters[b]] for b in range(256)], merges


def replay(words: list[str], path: str) -> list[list[int]]:
    """Token ids of every word, all words together.

    An index leads from each pair of neighbouring tokens to the places where it stands.  Merges are applied in order of
    their ranks, each at all its places, left to right; a merge takes its places out of the index and enters the pairs
    that its token makes with its neighbours.  Those have higher ranks, so a heap of the ranks that occur visits each once.
    """
    single, merges = load_merges(path)
    token: list[int] = []
    after: list[int] = []
    before: list[int] = []
    starts: list[int] = []
    index: dict[tuple[int, int], list[int]] = defaultdict(list)
    for word in words:
        ids = [single[b] for b in word.encode("utf-8", "surrogatepass")]
        at = len(token)
        starts.append(at if ids else -1)
        token += ids
        n = len(ids)
        before += [-1, *range(at, at + n - 1)][:n]
        after += [*range(at + 1, at + n), -1][:n]
        for i in range(n - 1):
            pair = (ids[i], ids[i + 1])
            if pair in merges:
                index[pair].append(at + i)
    heap = [(merges[p][0], p) for p in index]
    heapq.heapify(heap)
    while heap:
        rank, pair = heapq.heappop(heap)
        left, right = pair
        new = merges[pair][1]
        touched: set[tuple[int, int]] = set()
        for i in sorted(index.pop(pair, ())):
            j = after[i]
            if token[i] != left or j < 0 or token[j] != right:
                continue  # one of the two went into an earlier place of the same merge
            token[i], token[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (p := (new, token[k])) in merges:
                    index[p].append(i)
                    touched.add(p)
            h = before[i]
            if h >= 0 and (p := (token[h], new)) in merges:
                index[p].append(h)
                touched.add(p)
        for p in touched:
            heapq.heappush(heap, (merges[p][0], p))
    out = []
    for at in starts:
        ids = []
        while at >= 0:
            ids.append(token[at])
            at = after[at]
        out.append(ids)
    return out


def encode_corpus(documents: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids) of every row: the token ids of its whole text, without special tokens; strings of special tokens are ordinary text.

    Null and empty texts have the empty list.  Rows come out as they went in, repeated ones too, and rows with a null key.
    The corpus is cut into blocks of about BLOCK_BYTES by a hash of the row; each block's distinct words are gathered, the
    merges are replayed over the corpus's distinct words, and each block meets the ids of its own words only, so no task
    holds more than a block (or its longest text) and its words.
    """
    rows = documents.select(F.col(key).alias("__k"), F.col(text).alias("__t"))
    total = rows.agg(F.sum(F.octet_length("__t")).alias("b")).first().b or 0
    blocks = max(1, int(total // BLOCK_BYTES))
    full = rows.filter("__t is not null and __t <> ''").withColumn("__block", F.pmod(F.xxhash64("__k", "__t"), F.lit(blocks)).cast("int"))
    pattern = WORDS

    def vocabulary(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = regex.compile(pattern).findall
        for part in parts:
            seen: dict[int, set[str]] = defaultdict(set)
            for b, t in zip(part["__block"], part["__t"]):
                seen[b].update(find(t))
            for b, words in seen.items():
                yield pd.DataFrame({"block": b, "word": list(words)})

    used = settle(full.repartition("__block").mapInPandas(vocabulary, "block int, word string").distinct())

    def replayed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        file = path or tokenizer_file()

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array(waiting, pa.string()), pa.array(replay(waiting, file), pa.list_(pa.int32()))], names=["word", "word_ids"])

        for part in parts:
            waiting += part.column(0).to_pylist()
            if len(waiting) >= REPLAY_WORDS:
                yield done()
                waiting = []
        if waiting:
            yield done()

    ids = settle(used.select("word").distinct().mapInArrow(replayed, "word string, word_ids array<int>"))
    known = used.join(ids, "word").withColumnRenamed("block", "__block")
    kind = full.schema["__k"].dataType.simpleString()

    def encoded(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        find = regex.compile(pattern).findall
        of = dict(zip(right["word"], right["word_ids"]))
        return pd.DataFrame({"k": left["__k"], "ids": [[i for w in find(t) for i in of[w]] for t in left["__t"]]})

    some = full.groupBy("__block").cogroup(known.groupBy("__block")).applyInPandas(encoded, f"k {kind}, ids array<int>")
    none = rows.filter("__t is null or __t = ''").select(F.col("__k").alias("k"), F.array().cast("array<int>").alias("ids"))
    return some.unionByName(none).select(F.col("k").alias(key), "ids")


@lru_cache(2)
def ranked(path: str):
    """The same tokenizer in its library, for counting."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def token_count(path: str | None = None):
    """Arrow UDF: the number of tokens of a text by the tokenizer's own library; 0 for null and empty texts."""

    @F.pandas_udf(IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        t = ranked(path or tokenizer_file())
        return pd.Series([0 if not x else len(t.encode(x, add_special_tokens=False).ids) for x in texts], dtype="int32")

    return count


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p7_vocabulary_use(spark: SparkSession, folder: str) -> DataFrame:
    """How often each token id occurs in the corpus, and in how many documents; counts are combined before the shuffle."""
    ids = settle(p7_ids(spark, folder).select("ids"))
    each = ids.select(F.explode("ids").alias("token_id"), F.lit(1).alias("o"), F.lit(0).alias("d")).unionByName(ids.select(F.explode(F.array_distinct("ids")).alias("token_id"), F.lit(0).alias("o"), F.lit(1).alias("d")))
    return each.groupBy("token_id").agg(F.sum("o").alias("occurrences"), F.sum("d").alias("documents"))
