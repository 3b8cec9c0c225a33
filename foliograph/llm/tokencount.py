"""Operator 5, token counts by trie-shared dynamic programming over a unigram model.

The model is a public piece file: its normal pieces with the scores that the file carries (for a BPE file, minus the
place of the merge), so nothing is trained and a count is that of the segmentation with the best sum of those scores. A
text's pre-tokens are its words, each with the word mark before it. The distinct pre-tokens of a worker go into a trie;
each node holds the forward score of its prefix, the best sum over segmentations, and how many pieces that takes,
computed once however many pre-tokens share the prefix, from the nodes above it. The last node of a pre-token is its
stored count. A character that no piece covers costs one byte piece for each of its bytes. A pre-token of over LONG
characters (texts without blanks, encoded data) gets no nodes: the same scores roll on in a window as long as the longest
piece, so memory is bounded however long it is.

Defined results. Null or word-less text: zero counts, score 0. Ties of scores go to fewer pieces. Repeated rows are
counted row by row. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import release

MARK, LARGEST_FILE, NODES, KNOWN, LONG = "▁", 64 << 20, 1_500_000, 500_000, 64


def piece_scores(path: str) -> dict[str, float]:
    """Normal pieces of a sentencepiece model file and the scores they have there."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): float(sp.get_score(i)) for i in normal}


class Node:
    __slots__ = ("next", "score", "pieces")

    def __init__(self, score: float, pieces: int):
        self.next, self.score, self.pieces = {}, score, pieces


class Pieces:
    """The pieces by their ends: what may end where two characters stand."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        # a byte piece is worse than any normal piece
        self.byte = min(scores.values(), default=0.0) - 1.0 if scores else -1.0
        lengths: dict[str, set[int]] = {}
        for p in scores:
            lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {end: tuple(sorted(n)) for end, n in lengths.items()}

    def best(self, text: str, end: int, back: list[tuple[float, int]]) -> tuple[float, int]:
        """Score and pieces of the first `end` characters; back[-n] are those of the first end - n."""
        find, last = self.scores.get, text[end - 1]
        p, (score, pieces) = find(last), back[-1]
        if p is None:
            extra = len(last.encode(errors="replace"))
            score, pieces = score + self.byte * extra, pieces + extra
        else:  # better than a byte piece
            score, pieces = score + p, pieces + 1
        for size in self.lengths.get(text[end - 2 : end], ()) if end > 1 else ():
            if size > end:
                break
            p = find(text[end - size : end])
            if p is not None:
                s, n = back[-size]
                s += p
                if s > score or s == score and n + 1 < pieces:
                    score, pieces = s, n + 1
        return score, pieces


class Trie:
    def __init__(self, scores: dict[str, float]):
        self.pieces = Pieces(scores)
        self.root, self.nodes = Node(0.0, 0), 0
        self.known: dict[str, tuple[int, float]] = {}

    def count(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best segmentation of the mark and the word."""
        if len(word) > LONG:
            return self._roll(MARK + word)
        got = self.known.get(word)
        if got is None:
            if self.nodes > NODES:
                self.root, self.nodes = Node(0.0, 0), 0
            if len(self.known) >= KNOWN:
                self.known.clear()
            got = self.known[word] = self._insert(MARK + word)
        return got

    def _insert(self, text: str) -> tuple[int, float]:
        node, above, best = self.root, [(0.0, 0)], self.pieces.best
        for end, c in enumerate(text, 1):
            child = node.next.get(c)
            if child is None:
                child = node.next[c] = Node(*best(text, end, above))
                self.nodes += 1
            node = child
            above.append((node.score, node.pieces))
        return node.pieces, node.score

    def _roll(self, text: str) -> tuple[int, float]:
        """The same scores, of which only the last few are held."""
        room = self.pieces.longest
        back = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            back.append(self.pieces.best(text, end, back))
            if len(back) > 8 * room:
                del back[:-room]
        return back[-1][1], back[-1][0]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, score of each document."""
    if Path(path).stat().st_size > LARGEST_FILE:
        raise ValueError(f"{path} is over {LARGEST_FILE} bytes, too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(piece_scores(path))

    def run(batches):
        trie = Trie(shared.value)
        for batch in batches:
            out = []
            for x in batch["__text"]:
                words = (x.as_py() or "").split()
                # dict.get first: most words are known
                got = [trie.known.get(w) or trie.count(w) for w in words]
                n, scores = zip(*got) if got else ((), ())
                out.append((len(words), sum(n), float(sum(scores))))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["doc_id", "n_pretokens", "n_tokens", "score"])
        release()

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", F.col("text").alias("__text")).mapInArrow(run, schema)
