"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut at the special strings (one token each) and by the tokenizer's pattern into
pieces. A piece's bytes are a linked list; a heap holds (rank, position) of adjacent pairs,
the lowest is popped and merged, stale entries are skipped. The count is the number of
initial symbols minus the merges; no token ids are made. Pieces repeat, so each worker
keeps the counts of recent ones (bounded).

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted
each; an empty table gives no rows; extra columns are ignored.
"""

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The byte-level pre-tokenizer's pattern (fixed value of the tokenizer format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Counts kept per worker; the older half goes when it is full.
CACHE = 400_000


def byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Merges:
    """Ranks of the tokenizer's merges, by pairs of symbol numbers."""

    def __init__(self, spec: dict):
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normalizer or prefix space is needed")
        number: dict[str, int] = {s: b for b, s in byte_symbols().items()}
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            new = number.setdefault(a + b, len(number))
            self.ranks[number[a] << 32 | number[b]] = (rank, new)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, piece: bytes) -> int:
        """Symbols left of ``piece`` after all merges."""
        ranks, sym = self.ranks, list(piece)
        n = left = len(sym)
        heap = [(r[0], i, r[1]) for i in range(n - 1) if (r := ranks.get(sym[i] << 32 | sym[i + 1]))]
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i, new = heappop(heap)
            j = after[i]
            if sym[i] < 0 or j >= n or (r := ranks.get(sym[i] << 32 | sym[j])) is None or r[0] != rank:
                continue  # one of the pair was merged meanwhile
            sym[i], sym[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if r := ranks.get(new << 32 | sym[k]):
                    heappush(heap, (r[0], i, r[1]))
            if (h := before[i]) >= 0 and (r := ranks.get(sym[h] << 32 | new)):
                heappush(heap, (r[0], h, r[1]))
        return left


class Counts(dict):
    def __init__(self, merges: Merges):
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            for k in list(self)[: CACHE // 2]:
                del self[k]
        n = self.merges.count(piece.encode())
        if len(piece) <= 64:
            self[piece] = n
        return n


def counter(spec: dict):
    """text -> number of tokens, for a tokenizer file's content."""
    import regex

    merges = Merges(spec)
    counts, find = Counts(merges), regex.compile(PATTERN).findall
    special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None

    def count(text: str) -> int:
        if special is not None and special.search(text):
            parts = special.split(text)
            return len(parts) - 1 + sum(sum(map(counts.__getitem__, find(p))) for p in parts)
        return sum(map(counts.__getitem__, find(text)))

    return count


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit. ``tokenizer``: path of a byte-level BPE .json."""
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer)  # to every executor, also those that join later
    name = tokenizer.rsplit("/", 1)[-1]

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with open(SparkFiles.get(name)) as f:
            count = counter(json.load(f))
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return d.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
