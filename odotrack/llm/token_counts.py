"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

**The transducer.** Byte-pair encoding is decided by neighbours: a sequence of tokens is
the encoding of a word exactly if each adjacent pair is the encoding of its own bytes. So
the encoding of a prefix is fixed by its last token, and appending a byte needs only the
last tokens at the few positions where a token ending in that byte could begin. These,
with the longest suffix that begins a token and the differences in length between the
encodings there, are a state. There are finitely many; each transition carries the number
of tokens that it adds to the count. States are compiled when first met, and the table is
thrown away when it reaches a bound, so a worker's memory does not grow with its input.

**Chunks.** A text is cut at fixed places. What a chunk does to the state in which it is
entered is a map, kept as (head, count, tail): between its first and its last safe break
(one space between two characters that are no white space) the state is known and the
tokens are counted; before and behind, the entry or exit state decides. Maps compose
associatively. ``count`` reduces them; ``scan`` gives the count up to each cut and is not
used by the query.

Null text counts as empty: no tokens. Rows are counted one by one, so ties and repeated
rows do not matter; a column named like the new one is replaced."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.held import held
from odotrack.llm.pieces import SAFE, split_safe

#: Fixed value: the pattern that splits text before the merges, with white space as the
#: Unicode property. Taken over by byte-level vocabularies without one of their own.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Characters in a chunk; bounds on compiled transitions and on remembered words.
CHUNK, MAX_TRANSITIONS, MAX_WORDS, LONG_WORD = 1 << 16, 1 << 20, 1 << 19, 64
START = -1


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable Latin-1 characters
    for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Counts the tokens of words; see the module's text."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = vocabulary
        self.bytes_of = {i: t for t, i in vocabulary.items()}
        self.merges = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)
        }
        self.prefixes = {t[:n] for t in vocabulary for n in range(len(t))}
        self.letters = [vocabulary[bytes([b])] for b in range(256)]
        self._reset()

    def _reset(self) -> None:
        first = (b"", (START,), (0,))
        self.states, self.numbers = [first], {first: 0}
        self.same: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        #: state << 8 | byte: next state << 16 | added + 2 ** 15.
        self.table: dict[int, int] = {}

    def _merged(self, data: bytes) -> list[int]:
        """The encoding by its definition, for the few bytes of a pair of tokens."""
        ids = [self.letters[b] for b in data]
        while True:
            found = [(self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
            if not found:
                return ids
            i = min(found)[1]
            ids[i : i + 2] = [self.merges[ids[i], ids[i + 1]][1]]

    def _adjacent(self, left: int, right: int) -> bool:
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            alone = [right] if left == START else [left, right]
            known = self._merged(b"".join(self.bytes_of[i] for i in alone)) == alone
            self.pairs[key] = known
        return known

    def _compile(self, state: int, byte: int) -> int:
        suffix, last, behind = self.states[state]
        grown = suffix + bytes([byte])
        for back in range(len(grown) - 1, -1, -1):
            token = self.ids.get(grown[len(grown) - 1 - back :])
            if token is not None and self._adjacent(last[back], token):
                break
        added = 1 - behind[back]
        keep = next(n for n in range(len(grown), -1, -1) if grown[len(grown) - n :] in self.prefixes)
        ahead = (0, *(n + added for n in behind[:keep]))
        target = grown[len(grown) - keep :], (token, *last[:keep]), self.same.setdefault(ahead, ahead)
        number = self.numbers.setdefault(target, len(self.states))
        if number == len(self.states):
            self.states.append(target)
        step = number << 16 | added + (1 << 15)
        self.table[state << 8 | byte] = step
        return step

    def count(self, word: bytes) -> int:
        if len(self.table) > MAX_TRANSITIONS:
            self._reset()
        state = total = 0
        get = self.table.get
        for byte in word:
            step = get(state << 8 | byte) or self._compile(state, byte)
            state = step >> 16
            total += step & 0xFFFF
        return total - (len(word) << 15)


class _Remembered(dict):
    """Counts of pieces of text between safe breaks."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(piece) <= LONG_WORD:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[piece] = n
        return n


#: (head, count, tail); a chunk without a safe break is (text, None, "").
ChunkMap = tuple[str, int | None, str]


class TextCounter:
    """Token counts of texts, from the contents of a vocabulary file (JSON)."""

    def __init__(self, spec: bytes):
        model = json.loads(spec)
        if model["normalizer"] or model["pre_tokenizer"]["type"] != "ByteLevel" or model["model"]["ignore_merges"]:
            raise ValueError("only plain byte-level vocabularies are supported")
        letters = _byte_letters()
        decode = lambda t: bytes(letters[c] for c in t)
        special = [t["content"] for t in model["added_tokens"]]
        vocabulary = {decode(t): i for t, i in model["model"]["vocab"].items() if t not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.transducer = Transducer(vocabulary, [(decode(a), decode(b)) for a, b in pairs])
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) or r"(?!)")
        self.prefix_space = model["pre_tokenizer"]["add_prefix_space"]
        if self.prefix_space:
            raise ValueError("a vocabulary that adds spaces is not supported")
        self.split = regex.compile(SPLIT)
        self.first, self.later = _Remembered(self._piece), _Remembered(lambda piece: self._piece(" " + piece))

    def _piece(self, piece: str) -> int:
        found = self.special.findall(piece)
        count = self.transducer.count
        return len(found) + sum(
            count(word.encode())
            for plain in (self.special.split(piece) if found else [piece])
            for word in self.split.findall(plain)
        )

    def _run(self, text: str, at_start: bool) -> int:
        """Tokens of a text that ends at a safe break or at its end. If it does not begin
        the document, it begins with the space of a safe break."""
        if not text:
            return 0
        if not at_start:
            text = text[1:]
        pieces = split_safe(text)
        first = (self.first if at_start else self.later)[pieces[0]]
        return first + sum(map(self.later.__getitem__, pieces[1:]))

    def chunk_map(self, text: str) -> ChunkMap:
        one = SAFE.search(text)
        if one is None:
            return text, None, ""
        at = len(text) - 1
        while True:  # the last safe break
            at = text.rfind(" ", 0, at)
            if SAFE.match(text, at):
                break
        return text[: one.start()], self._run(text[one.start() : at], False), text[at:]

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """What two neighbouring chunks do. The text between their outermost safe breaks
        is whole now; a break may lie just where they meet."""
        if a[1] is None and b[1] is None:
            return self.chunk_map(a[0] + b[0])
        if a[1] is None:
            head, count, tail = self.chunk_map(a[0] + b[0])
            if count is None:
                return head, b[1], b[2]
            return head, count + self._run(tail, False) + b[1], b[2]
        if b[1] is None:
            head, count, tail = self.chunk_map(a[2] + b[0])
            # ``a[2]`` begins with a safe break, which its own text alone does not show.
            whole = a[2] + b[0]
            if count is None:
                return a[0], a[1], whole
            return a[0], a[1] + self._run(whole[: len(whole) - len(tail)], False), tail
        return a[0], a[1] + self._run(a[2] + b[0], False) + b[1], b[2]

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix compositions, in a logarithmic number of rounds."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i]) for i in range(step, len(maps))]
            step *= 2
        return maps

    def reduce(self, maps: list[ChunkMap]) -> ChunkMap:
        """The last of ``scan`` by pairs, round by round."""
        while len(maps) > 1:
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        return maps[0]

    def total(self, mapped: ChunkMap) -> int:
        """The count of a whole text with this map."""
        head, count, tail = mapped
        if count is None:
            return self._run(head, True)
        return self._run(head, True) + count + self._run(tail, False)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk:
            return self._run(text, True)
        return self.total(self.reduce([self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]))


def counter(spec: bytes) -> TextCounter:
    """One compiled counter per worker and vocabulary."""
    return held(("counter", hashlib.sha256(spec).digest()), lambda: TextCounter(spec))


def token_counter(docs: DataFrame, path: str, chunk: int = CHUNK):
    """A column function for the vocabulary at ``path`` on the driver; the workers get its
    contents."""
    spec = docs.sparkSession.sparkContext.broadcast(open(path, "rb").read())

    def counts(batches: Iterable[pd.Series]) -> Iterator[pd.Series]:
        own = counter(spec.value)
        for texts in batches:
            yield pd.Series([own.count(t, chunk) if t else 0 for t in texts], dtype="int64")

    counts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(counts, "long")


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens", chunk: int = CHUNK
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text."""
    column: Column = token_counter(docs, path, chunk)(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn(into, column)
