"""SentencePiece encoding and decoding through a table of distinct marked words.

A text becomes marked words: the whitespace marker stands for each blank and before the text, and a
marked word is a run of markers with what follows up to the next run. If no piece of the vocabulary
continues with a marker after another character (``separable``), pieces never cross from one marked
word to the next, so each distinct word is segmented once per task and ids are joined back by position.
A task keeps the ``table_size`` to twice as many words it met last; the result does not depend on that.
Other vocabularies raise an error.

Decoding uses the same table: a marked word's ids decode to the same text wherever it stands.

Null texts count as empty (no ids, empty text). Repeated rows and extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import give_back, small_batches, text_or_empty

MARKER = "▁"
RESULT = "ids array<int>, decoded string"


def separable(processor) -> bool:
    """No piece has a marker after another character, and words start with a marker of their own."""
    crossing = re.compile(f"[^{MARKER}]{MARKER}")
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    plain = processor.normalize("a  b ") == f"{MARKER}a{MARKER}{MARKER}b{MARKER}"
    return plain and not any(crossing.search(p) for p in pieces)


class WordTable:
    """Distinct marked words (named without their first marker) with their ids as int32 bytes.

    Two generations: when the young one holds ``size`` words it becomes the old one; words met again
    move up, the others are forgotten with it.
    """

    def __init__(self, model: bytes, size: int):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}  # words that decode to another text than their own
        pieces = (self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size()))
        self.starts = np.array([p.startswith(MARKER) for p in pieces])
        # What the encoder yields for a marker that ends the text.
        self.last = np.array([self.processor.piece_to_id(MARKER)], dtype="<i4").tobytes()

    def words(self, text: str) -> list[str]:
        """The marked words of a text that is not empty, in order."""
        marked = self.processor.normalize(text)
        if MARKER + MARKER in marked or marked.endswith(MARKER):
            return _WORDS.findall(marked)
        return marked.split(MARKER)[1:]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Segment words: those without inner markers in one text, as each then has one marker."""
        every = [w for w in words if w and MARKER not in w]
        out = {}
        for at in range(0, len(every), RUN_WORDS):
            plain = every[at : at + RUN_WORDS]
            ids = self.processor.encode(" ".join(plain), num_threads=1)
            texts = self.processor.decode(ids).split(" ")
            values = np.array(ids, dtype="<i4")
            edges = np.append(np.flatnonzero(self.starts[values]), len(values))
            if not len(texts) == len(edges) - 1 == len(plain):
                raise ValueError("a piece crosses from one marked word to the next")
            raw, edges = values.tobytes(), (4 * edges).tolist()
            out.update((w, raw[a:b]) for w, a, b in zip(plain, edges, edges[1:]))
            if plain != texts:
                self.changed.update((w, t) for w, t in zip(plain, texts) if w != t)
        for word in words:
            if word not in out:
                ids = self.processor.encode(word)
                out[word] = np.array(ids, dtype="<i4").tobytes() if word else self.last
                if (text := self.processor.decode(ids)) != word:
                    self.changed[word] = text
        return out

    def entries(self, words: set[str]) -> dict[str, bytes]:
        """The table with an entry for each of ``words``."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
            self.changed = {w: t for w, t in self.changed.items() if w in self.old}
        new = [w for w in words if w not in self.young]
        up = {w: self.old[w] for w in new if w in self.old}
        self.young.update(up)
        if len(up) < len(new):
            self.young.update(self.learn([w for w in new if w not in up]))
        return self.young

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of each text, worked off in runs of bounded length."""
        ids, decoded = [], []
        at = 0
        while at < len(texts):
            until, size = at, 0
            while until < len(texts) and (until == at or size + len(texts[until]) <= RUN_CHARS):
                size += len(texts[until])
                until += 1
            split = [self.words(t) if t else [] for t in texts[at:until]]
            known = self.entries(set().union(*split))
            for words in split:
                ids.append(b"".join([known[w] for w in words]))
                # Decoding drops the marker in front of the text only.
                if self.changed:
                    words = [self.changed.get(w, w) for w in words]
                decoded.append(" ".join(words))
            at = until
        return ids, decoded


_WORDS = re.compile(f"{MARKER}({MARKER}*[^{MARKER}]*)")
RUN_CHARS = 250_000
RUN_WORDS = 500


def _structs(ids: list[bytes], decoded: list[str]) -> pa.StructArray:
    offsets = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), pa.int32())
    lists = pa.ListArray.from_arrays(pa.array(offsets), values)
    return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], names=["ids", "decoded"])


def encoder(model_path: str, table_size: int = 100_000):
    """An Arrow function text -> struct of ``RESULT``. The model file is read on the driver."""
    with open(model_path, "rb") as file:
        model = file.read()
    if not separable(WordTable(model, 0).processor):
        raise ValueError("pieces of this vocabulary may cross whitespace markers")

    @F.arrow_udf(returnType=T.StructType.fromDDL(RESULT))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = WordTable(model, table_size)
        try:
            for texts in batches:
                yield _structs(*table.run(texts.to_pylist()))
        finally:
            del table
            give_back()

    return run


def encoded(docs: DataFrame, model_path: str, *, text: str = "text", into: str = "pieces", table_size: int = 100_000) -> DataFrame:
    """``docs`` with a struct column ``into``: the ids and the text decoded from them.

    A column of that name is replaced; to keep it, name another.
    """
    return small_batches(docs).withColumn(into, encoder(model_path, table_size)(text_or_empty(text)))
