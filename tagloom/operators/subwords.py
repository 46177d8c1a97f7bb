"""Sub-word ids with a given vocabulary: the longest piece first, in time linear in the text.

Pieces within a word start with a mark. A trie with failure links does not go back over characters: where
a piece can go no further, its link says which pieces are certain by then and where in the trie what is left of
the word stands.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text as fn
from tagloom.operators.textfeatures import PAD, UNKNOWN

# Largest vocabulary, in bytes of its pieces, that is sent to every task.
VOCABULARY_BYTES = 64 << 20

# Words whose ids a task remembers.
REMEMBERED = 200_000

# Documents of a batch whose words a task holds as texts of their own.
AT_ONCE = 500

CONTINUED = "##"
CHARACTERS = 0x110000


class Pieces:
    """A trie of pieces. Node 0 is the start of a word, node 1 the place after a piece of it.

    All steps are in one dictionary, by node and character, as one for each node would take several times the memory."""

    START, INSIDE = 0, 1

    def __init__(
        self, vocabulary: dict[str, int] | Iterable[tuple[str, int]], unknown: int = UNKNOWN, mark: str = CONTINUED
    ):
        self.unknown = unknown
        self.steps: dict[int, int] = {}
        self.ends: list[int | None] = [None, None]
        came = array("q", [0, 0])  # the step that leads to a node
        depths = array("i", [0, 0])
        for piece, number in vocabulary.items() if isinstance(vocabulary, dict) else vocabulary:
            inside = bool(mark) and piece.startswith(mark) and piece != mark
            self._add(self.INSIDE if inside else self.START, piece[len(mark) :] if inside else piece, number, came, depths)
        self._link(came, depths)

    def _add(self, node: int, piece: str, number: int, came: array, depths: array) -> None:
        if not piece:
            return
        for depth, c in enumerate(piece, 1):
            step = node * CHARACTERS + ord(c)
            node = self.steps.setdefault(step, len(self.ends))
            if node == len(self.ends):
                self.ends.append(None)
                came.append(step)
                depths.append(depth)
        self.ends[node] = number

    def _link(self, came: array, depths: array) -> None:
        self.links: list[int | None] = [None] * len(self.ends)
        self.certain: list[tuple[int, ...]] = [()] * len(self.ends)
        for node in sorted(range(2, len(self.ends)), key=depths.__getitem__):
            if self.ends[node] is not None:
                self.links[node], self.certain[node] = self.INSIDE, (self.ends[node],)
                continue
            parent, c = divmod(came[node], CHARACTERS)
            at, more = self.links[parent], self.certain[parent]
            while at is not None and at * CHARACTERS + c not in self.steps:
                more += self.certain[at]
                at = self.links[at]
            if at is not None:
                self.links[node], self.certain[node] = self.steps[at * CHARACTERS + c], more

    def ids(self, word: str) -> list[int]:
        """Ids of the word's pieces; the unknown one alone if it can't be made of pieces."""
        node, out = self.START, []
        for c in word:
            while (following := self.steps.get(node * CHARACTERS + ord(c))) is None:
                if self.links[node] is None:
                    return [self.unknown]
                out += self.certain[node]
                node = self.links[node]
            node = following
        while node != self.INSIDE:
            if self.links[node] is None:
                return [self.unknown]
            out += self.certain[node]
            node = self.links[node]
        return out


def encode_subwords(
    docs: DataFrame,
    vocabulary: DataFrame,
    length: int = 512,
    lowercase: bool = True,
    mark: str = CONTINUED,
) -> DataFrame:
    """(doc_id, n_pieces, input_ids, attention_mask) of every row of ``docs`` (doc_id, text), with the pieces of
    ``vocabulary`` (token, token_id).

    The whole text is encoded, which ``n_pieces`` counts; the first ``length`` ids are kept, padded. A NULL or empty
    text has none. Rows stay where they are; repeated and NULL keys stay rows of their own. The vocabulary
    passes through the driver and is sent to every task, so its size is checked; of a piece named twice the
    smallest id counts.
    """
    spark = docs.sparkSession
    known = vocabulary.filter("token IS NOT NULL").groupBy("token").agg(F.min("token_id").alias("token_id"))
    if (known.agg(F.sum(F.octet_length("token"))).first()[0] or 0) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be sent to every task")
    known = known.toArrow()
    sent = spark.sparkContext.broadcast((known.column("token").combine_chunks(), known.column("token_id").combine_chunks()))
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Pieces(((t.as_py(), int(i.as_py())) for t, i in zip(*sent.value)), mark=mark)
        memory: dict[str, list[int]] = {}
        for batch in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
            counts, rows = [], []
            for words in batch.column(1).to_pylist():
                ids: list[int] = []
                n = 0
                for word in words or ():
                    own = memory.get(word)
                    if own is None:
                        own = matcher.ids(word)
                        if len(memory) < REMEMBERED:
                            memory[word] = own
                    n += len(own)
                    if len(ids) < length:
                        ids += own
                counts.append(n)
                rows.append(ids[:length])
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(rows, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_pieces", "ids"])

    words = docs.select("doc_id", fn.words("text", lowercase).alias("words"))
    coded = words.mapInArrow(run, f"doc_id {key}, n_pieces long, ids array<int>")
    gap = F.lit(length) - F.size("ids")
    return coded.select(
        "doc_id",
        "n_pieces",
        F.concat("ids", F.array_repeat(F.lit(PAD), gap)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), gap)).alias("attention_mask"),
    )

