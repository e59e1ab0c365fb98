"""Byte-level BPE encoding and decoding with higher-order functions.

Bytes are handled as Latin-1 strings, one character a byte, so that pieces concatenate,
join and look up as strings. The rank map is a literal: an array of small maps, found by
a checksum of the piece, since Spark searches a map entry by entry.

A word is folded: the accumulator holds its pieces and the rank of each adjacent pair; a
step merges the leftmost pair of smallest rank and looks up the two pairs that are new.

**Two ways over a corpus.** ``ByteBpe.encode`` is that fold on every word of a text, in
one projection. It takes about 43 microseconds a word of ten letters, all of it
interpretation of the lambda's expression, which is three times what a corpus with many
rare words allows. ``encode_and_decode`` therefore folds distinct words: Spark counts
them, the fold encodes the ``FREQUENT`` most frequent ones (nine tenths of all
occurrences here), and their ids are broadcast, a table of bounded size. Arrow batches of
texts are looked up in it; words that are not there are merged by the same ranks in the
worker, which remembers a bounded number of them. Neither way shuffles texts, and results
do not depend on ``FREQUENT``. Decoding is the higher-order one in both.

Null text is empty: no ids, empty bytes. Ids outside the vocabulary decode to null.
Rows are independent, so ties and repeated rows get equal results. Columns of the same
names as the results are replaced, all others pass through."""

from __future__ import annotations

import base64
import heapq
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odotrack.llm.common import let, or_empty
from odotrack.llm.held import held
from odotrack.llm.pieces import split_safe
from odotrack.session import stage

FREQUENT = 1 << 17
BUCKETS = 1 << 16
#: Rare words, and pieces between spaces, that a worker remembers.
RARE, PIECES = 3 << 17, 3 << 17
#: Rows of a batch of whole texts.
BATCH = 1000
NO_RANK = (1 << 31) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 piece and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _literal(entries: dict[str, object], value_type: str) -> Column:
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = value
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), f"array<map<string,{value_type}>>")


def _look_up(buckets: Column, key: Column) -> Column:
    return F.try_element_at(F.get(buckets, F.crc32(key).bitwiseAND(BUCKETS - 1).cast("int")), key)


def latin(text: Column) -> Column:
    """The UTF-8 bytes of a text, a character each."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _pattern(pattern: str) -> str:
    """Character classes are Unicode's in Java only when asked for."""
    return f"(?U){pattern}"


class ByteBpe:
    """Columns that encode and decode by a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = _pattern(pattern)
        self.ranks = _literal({piece.decode("latin-1"): rank for piece, rank in ranks.items()}, "int")
        self.n_pieces = max(ranks.values()) + 1
        self.holes = sorted(set(range(self.n_pieces)) - set(ranks.values()))
        pieces = [""] * self.n_pieces
        for piece, rank in ranks.items():
            pieces[rank] = piece.decode("latin-1")
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(or_empty(text), F.lit(self.pattern), F.lit(0))

    def fold(self, word: Column) -> Column:
        """The ids of one word."""
        return let(self.ranks, lambda ranks: self._fold(word, ranks))

    @staticmethod
    def _fold(word: Column, rank_map: Column) -> Column:
        rank = lambda piece: _look_up(rank_map, piece)
        pair = lambda a, b: F.coalesce(rank(F.concat(a, b)), F.lit(NO_RANK))

        def step(acc: Column, _: Column) -> Column:
            pieces, ranks = acc["pieces"], acc["ranks"]

            def merged(k: Column) -> Column:
                whole = F.concat(F.get(pieces, k - 1), F.get(pieces, k))
                n = F.size(pieces)
                none = F.array().cast("array<int>")
                return let(
                    whole,
                    lambda w: F.struct(
                        F.concat(F.slice(pieces, 1, k - 1), F.array(w), F.slice(pieces, k + 2, n)).alias("pieces"),
                        F.concat(
                            F.slice(ranks, 1, F.greatest(k - 2, F.lit(0))),
                            F.when(k > 1, F.array(pair(F.get(pieces, k - 2), w))).otherwise(none),
                            F.when(k < n - 1, F.array(pair(w, F.get(pieces, k + 1)))).otherwise(none),
                            F.slice(ranks, k + 2, n),
                        ).alias("ranks"),
                    ),
                )

            smallest = F.array_min(ranks)
            return F.when(F.coalesce(smallest, F.lit(NO_RANK)) == NO_RANK, acc).otherwise(
                let(F.array_position(ranks, smallest).cast("int"), merged)
            )

        def folded(pieces: Column) -> Column:
            n = F.size(pieces)
            ranks = F.transform(F.slice(pieces, 1, n - 1), lambda x, i: pair(x, F.get(pieces, i + 1)))
            return F.aggregate(
                F.slice(pieces, 1, n - 1),
                F.struct(pieces.alias("pieces"), ranks.alias("ranks")),
                step,
                lambda acc: F.transform(acc["pieces"], rank),
            )

        def encoded(data: Column) -> Column:
            return let(
                rank(data),
                lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(let(F.split(data, ""), folded)),
            )

        return let(latin(word), encoded)

    def frequent(self, docs: DataFrame, text: str = "text", most: int = FREQUENT) -> dict[str, bytes]:
        """The words that occur most often in ``docs``, at most ``most``, with their ids as
        the bytes of 32-bit integers.

        A histogram of the counts gives the least count that keeps the bound, so that no
        sort is needed and no more than the result leaves the executors."""
        words = docs.select(F.explode(self.words(F.col(text))).alias("word"))
        counted = words.groupBy("word").agg(F.count("*").alias("n"))
        counted = stage(counted.withColumn("size", F.floor(F.log2("n") * 32).cast("int")))
        taken, least = 0, None
        for size, n in sorted(counted.groupBy("size").count().collect(), reverse=True):  # 2048 rows at most
            taken += n
            if taken > most:
                break
            least = size
        if least is None:
            return {}
        top = counted.filter(F.col("size") >= least).select("word")
        rows = top.select("word", self.fold(F.col("word")).alias("ids")).toArrow().combine_chunks()
        ids = rows["ids"].combine_chunks()
        ends, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        return {w: values[i:j].tobytes() for w, i, j in zip(rows["word"].to_pylist(), ends, ends[1:])}

    def encode(self, text: Column) -> Column:
        """array<int>, folding each word where it stands."""
        return let(
            self.ranks,
            lambda ranks: F.flatten(F.transform(self.words(text), lambda w: self._fold(w, ranks))),
        )

    def decode(self, ids: Column) -> Column:
        """The bytes of a sequence of ids; null if one is unknown."""
        def joined(table: Column) -> Column:
            pieces = F.transform(ids, lambda i: F.get(table, i))
            return F.encode(F.array_join(pieces, ""), "ISO-8859-1")

        known = (F.array_min(ids) >= 0) & (F.array_max(ids) < self.n_pieces)
        for hole in self.holes:
            known = known & ~F.array_contains(ids, hole)
        return F.when(F.coalesce(known, F.size(ids) == 0), let(self.pieces, joined))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: adjacent pieces of smallest rank merge first, the leftmost of
    equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _merge_long(word, ranks)
    get = ranks.get
    pieces = [word[i : i + 1] for i in range(len(word))]
    pairs = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs and (least := min(pairs)) != NO_RANK:
        i = pairs.index(least)
        whole = pieces[i] = pieces[i] + pieces.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(whole + pieces[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = get(pieces[i - 1] + whole, NO_RANK)
    return [ranks[piece] for piece in pieces]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, since a scan a merge takes quadratic time."""
    end = len(word)
    upto, before = list(range(1, end + 1)), list(range(-1, end))  # a piece begins at each live index
    rank = lambda i: ranks.get(word[i : upto[upto[i]]]) if upto[i] < end else None
    pairs = [(r, i, upto[i + 1]) for i in range(end - 1) if (r := rank(i)) is not None]
    heapq.heapify(pairs)
    live = bytearray(b"\1" * end)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        middle = upto[i]
        if not live[i] or middle == end or upto[middle] != stop:
            continue  # one of the two has merged with another since
        live[middle] = 0
        upto[i] = stop
        if stop < end:
            before[stop] = i
            if (r := rank(i)) is not None:
                heapq.heappush(pairs, (r, i, upto[stop]))
        if i > 0 and (r := rank(left := before[i])) is not None:
            heapq.heappush(pairs, (r, left, stop))
    ids, i = [], 0
    while i < end:
        ids.append(ranks[word[i : upto[i]]])
        i = upto[i]
    return ids


class _Bounded(dict):
    """Remembers what ``make`` gives for short keys, and starts anew when full."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class TextCoder:
    """Ids of whole texts, as the bytes of 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: dict[str, bytes]):
        self.ranks, self.known = ranks, known
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.rare = _Bounded(lambda w: np.array(merge(w.encode(), self.ranks), np.int32).tobytes(), RARE)
        self.marks = {c: np.array(merge(c.encode(), ranks), np.int32).tobytes() for c in ".,;:!?"}
        self.first = _Bounded(self._piece, PIECES)
        self.later = _Bounded(lambda piece: self._piece(" " + piece), PIECES)

    def _piece(self, piece: str) -> bytes:
        known, rare = self.known, self.rare
        # Most pieces are a space, letters and at most one mark: no need for the pattern.
        if piece[1:].isalpha() and piece[0] == " ":
            return known.get(piece) or rare[piece]
        mark = self.marks.get(piece[-1:])
        if mark and piece[1:-1].isalpha() and piece[0] == " ":
            return (known.get(piece[:-1]) or rare[piece[:-1]]) + mark
        return b"".join([known.get(w) or rare[w] for w in self.split.findall(piece)])

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = split_safe(text)
        return self.first[pieces[0]] + b"".join(map(self.later.__getitem__, pieces[1:]))


def text_encoder(spark: SparkSession, ranks: dict[bytes, int], pattern: str, known: dict[str, bytes]):
    """A column function from text to array<int>."""
    # Batches hold whole texts and their ids; the setting holds for the session.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    shared = spark.sparkContext.broadcast((ranks, pattern, known))
    name = uuid.uuid4().hex

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = held(("coder", name), lambda: TextCoder(*shared.value))
        for texts in batches:
            coded = [coder.encode(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "array<int>")


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = FREQUENT) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, the bytes that they stand for."""
    bpe = ByteBpe(ranks, pattern)
    encode = text_encoder(docs.sparkSession, ranks, pattern, bpe.frequent(docs, "text", most))
    encoded = docs.withColumn("ids", encode(or_empty(F.col("text"))))
    return encoded.withColumn("decoded", bpe.decode(F.col("ids")))
