"""Best-fit packing of tokenised documents into fixed-length sequences.

Large-item matching on the histogram of piece lengths: lengths above a third
of the capacity are matched greedily, at most two to a bin; smaller ones go,
longest first, to the fullest bin that still has room (best fit). The plan
is made over lengths with multiplicities - at most ``capacity`` rows, however
many documents there are - and says for each length which ranks go to which
bins. Spark then ranks the pieces within their length and looks the place up.

Defined results: a null or empty text is a document of one token, id 0;
repeated rows are packed each on its own; ties are broken by doc_id; an empty
table gives no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.batches import to_arrow
from cartwheel.llm.common import materialise, of_columns

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k"
SEPARATOR_ID = 0
PIECES = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}


#: Runs of white space from this length on are left to the reference tokenizer: the fast one's pattern goes a level
#: deeper with every character of such a run, and overflows the stack at about a million.
LONG_RUN = re.compile(r"\s{1000}")


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Token ids as ``Tokenizer.from_file(<vocabulary>.json)`` gives them with
    ``add_special_tokens=False``: the string of a special token in a text is
    that token. Texts without such strings and without long runs of white
    space go through the same ranks in a faster reader, with the same ids."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(t in text for t in special) or LONG_RUN.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)
    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``n`` tokens: whole capacities, the
    remainder first."""
    head = n % capacity
    bounds = [0] * (head > 0) + list(range(head, n + 1, capacity))
    return list(zip(bounds, bounds[1:]))


def token_pieces(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the
    ids themselves if asked for."""
    kinds = PIECES | ({"ids": "array<long>"} if with_ids else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in kinds}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = array("I", encode(text.as_py()) if text.is_valid else [])
                ids.append(SEPARATOR_ID)
                raw = memoryview(ids.tobytes())
                for k, (a, b) in enumerate(cut(len(ids), capacity)):
                    for c, v in zip(kinds, (doc_id, k, a, b - a, zlib.crc32(raw[4 * a:4 * b]), ids[a:b])):
                        rows[c].append(v)
            yield pa.RecordBatch.from_arrays([to_arrow(rows[c], kind) for c, kind in kinds.items()], names=list(kinds))

    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    return of_columns(documents, "doc_id", "text").mapInArrow(run, schema)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, copies per bin, first bin, offset) for all
    ranks of all lengths.

    A group stands for ``count`` bins that hold the same lengths. Each length
    either uses up a group's bins or is used up itself, so there are at most
    as many groups as lengths and splits, independent of the counts."""
    left = {n: c for n, c in histogram.items() if c > 0}
    groups: list[tuple[int, list[tuple[int, int]]]] = []  # (bins, [(length, copies)])
    gaps: list[tuple[int, int]] = []  # (room, group), sorted

    def add(count: int, items: list[tuple[int, int]]) -> None:
        groups.append((count, items))
        room = capacity - sum(n * k for n, k in items)
        if room:
            insort(gaps, (room, len(groups) - 1))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left.get(n):
            # the largest partner that fits; a bin gets no third large item
            mate = next((m for m in large if m <= n and n + m <= capacity and left.get(m, 0) > (m == n)), None)
            if mate is None:
                add(left.pop(n), [(n, 1)])
            elif mate == n:
                pairs, odd = divmod(left[n], 2)
                add(pairs, [(n, 2)])
                left[n] = odd
            else:
                bins = min(left[n], left[mate])
                add(bins, [(n, 1), (mate, 1)])
                left[n] -= bins
                left[mate] -= bins
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, (n, -1))
            if at == len(gaps):
                per = capacity // n
                full, rest = divmod(left[n], per)
                left[n] = 0
                if full:
                    add(full, [(n, per)])
                if rest:
                    add(1, [(n, rest)])
                break
            room, g = gaps.pop(at)
            bins, items = groups[g]
            per = min(room // n, -(-left[n] // bins))
            used = min(bins, left[n] // per)
            left[n] -= used * per
            groups[g] = (0, [])
            add(used, [*items, (n, per)])
            if used < bins:
                add(bins - used, items)
    rank: dict[int, int] = {}
    places, first_bin = [], 0
    for bins, items in groups:
        offset = 0
        for n, copies in items if bins else []:
            places.append((n, rank.get(n, 0), bins * copies, copies, first_bin, offset))
            rank[n] = rank.get(n, 0) + bins * copies
            offset += n * copies
        first_bin += bins
    return places


def ranked(pieces: DataFrame, per_task: int = 1_000_000) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length.

    A length may hold a third of all pieces, so each is dealt to as many
    salts as keep a window group near ``per_task`` rows; the salts' counts
    give each group its first rank."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(per_task))).cast("long")
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).select("length", salts.alias("salts"))
    salted = (pieces.join(F.broadcast(counts), "length")  # at most `capacity` rows
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts"))).drop("salts"))
    by_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_salt.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (salted.withColumn("own", F.row_number().over(own) - 1).join(firsts, ["length", "salt"])
            .withColumn("rank", F.col("first") + F.col("own")).drop("salt", "first", "own"))


def pack(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
         with_ids: bool = False) -> DataFrame:
    """Each piece with its sequence_id and offset; with_ids keeps the ids."""
    spark = documents.sparkSession
    pieces = materialise(token_pieces(documents, capacity, vocabulary, with_ids))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.createDataFrame(
        plan_bins(histogram, capacity),
        "length long, first_rank long, ranks long, copies long, first_bin long, first_offset long")
    r, p = ranked(pieces).alias("r"), F.broadcast(places).alias("p")
    on = ((F.col("r.length") == F.col("p.length")) & (F.col("r.rank") >= F.col("p.first_rank"))
          & (F.col("r.rank") < F.col("p.first_rank") + F.col("p.ranks")))
    at = F.col("r.rank") - F.col("p.first_rank")
    return r.join(p, on).select(
        *[F.col(f"r.{c}") for c in pieces.columns],
        (F.col("p.first_bin") + F.floor(at / F.col("p.copies"))).alias("sequence_id"),
        (F.col("p.first_offset") + at % F.col("p.copies") * F.col("r.length")).alias("offset"))
