"""Exact token counts, with overlap resynchronisation for huge documents.

A document over ``CHUNK`` bytes is encoded in chunks that overlap. Two neighbouring encodings
are spliced at a token boundary that both share and that is proven stable: the character before it
is no space and the one after it is, and no piece of the vocabulary holds a space behind a
non-space, so no merge can cross it and each side encodes alike with or without the other. Where an
overlap has no such boundary, it is widened, up to the rest of the document.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.llm.common import utf8

#: Bytes of a chunk; longer documents are encoded in chunks.
CHUNK = 32_768
#: Bytes that two chunks share at first; doubled whenever no stable boundary lies inside.
OVERLAP = 256
#: Tokens above which a document is over the limit.
LIMIT = 4_096

#: Fixed value: the mark that sentencepiece writes for a space.
SPACE = "▁"


class Encoder:
    """Counts tokens with a sentencepiece model; one for each Python worker."""

    def __init__(self, model: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.chunk, self.overlap = chunk, overlap
        self.proven = self._no_crossing_piece() and self._identity()

    def _no_crossing_piece(self) -> bool:
        """No piece has a space mark behind another character."""
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        return not any(SPACE in piece.lstrip(SPACE) for piece in pieces)

    def _identity(self) -> bool:
        """The model leaves texts as they are, but for one leading space."""
        probe = " a  Åﬁ① é  "
        return self.model.decode(self.model.encode(probe)) == probe

    def _ends(self, raw: bytes, start: int, stop: int) -> list[int]:
        """Byte offset in ``raw`` behind each token of ``raw[start:stop]``, from the tokens' own offsets."""
        proto = self.model.encode(raw[start:stop].decode("utf-8"), out_type="proto", num_threads=1)
        return [start + piece.end for piece in proto.pieces]

    def ends(self, raw: bytes) -> list[int]:
        """Byte offset behind each token of the whole text, spliced from overlapping chunks."""
        if len(raw) <= self.chunk or not self.proven:
            return self._ends(raw, 0, len(raw))
        done: list[int] = []  # token ends up to ``at``, final
        at, start, stop, overlap = -1, 0, _aligned(raw, self.chunk), self.overlap
        open_ends = self._ends(raw, start, stop)  # those behind ``at`` are open
        while stop < len(raw):
            begin = _aligned(raw, max(at, stop - overlap, 0))
            until = _aligned(raw, stop + self.chunk)
            following = self._ends(raw, begin, until)
            shared = set(following)
            cut = next(
                (e for e in reversed(open_ends) if begin < e < stop and e in shared and _stable(raw, e)), None
            )
            if cut is not None:
                done += [e for e in open_ends if at < e <= cut]
                at, start, stop, overlap = cut, begin, until, self.overlap
                open_ends = [e for e in following if e > cut]
            elif begin > max(at, 0):
                overlap *= 2
            else:  # the overlap is all of the open part: take a longer chunk
                stop = _aligned(raw, stop + (stop - begin))
                open_ends = [e for e in self._ends(raw, start, stop) if e > at]
        return done + open_ends

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(text) <= self.chunk // 4 or not self.proven:  # four bytes a character at most
            return len(self.model.encode(text, num_threads=1))
        raw = utf8(text)
        if len(raw) <= self.chunk:
            return len(self.model.encode(text, num_threads=1))
        return len(self.ends(raw))


def _aligned(raw: bytes, at: int) -> int:
    """The start of the character that holds byte ``at``, or the text's end."""
    if at >= len(raw):
        return len(raw)
    while raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _stable(raw: bytes, at: int) -> bool:
    """A space follows and none precedes; the mark itself counts as a space."""
    mark = SPACE.encode()
    before, after = raw[max(0, at - 3) : at], raw[at : at + 3]
    return (after[:1] == b" " or after == mark) and before[-1:] != b" " and before != mark


def token_count(text: Column, model: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Tokens of the whole text; null and empty texts have none."""
    built: list[Encoder] = []

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Encoder(model, chunk, overlap))
        return pa.array([built[0].count(t.as_py()) for t in texts], pa.int64())

    return counted(text)


def count_tokens(docs: DataFrame, model: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit. All rows and columns stay; null counts as empty."""
    text = F.col(text_col)
    return docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "n_tokens": token_count(text, model),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
