"""SentencePiece encoding and decoding of a BPE model with byte fallback.

The exact merge result is found without merging: at each position take the longest piece that an Aho-Corasick
automaton finds there, accept it if it may stand behind the piece before, else try its next shorter prefix, else
step back. Two pieces may be neighbours if merging their joined text by score gives the same two pieces; a sequence
whose neighbours all pass is the merge result. A bit per position remembers where no way leads on.

No piece has a blank behind another character, so a text falls into runs of blanks each with the word behind it.
Blank runs longer than one have the lowest score and only merge among themselves, after everything else.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import Memo, texts, tokenizer_file

BLANK = "▁"


class PieceModel:
    """Pieces, scores and the encoding of one model file."""

    def __init__(self, file: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.end_id = model.eos_id()
        self.score, self.id_of, self.bytes_id, self.piece_of = {}, {}, {}, {}
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                self.bytes_id[int(piece[3:5], 16)] = number
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                self.id_of[piece], self.score[piece], self.piece_of[number] = number, model.get_score(number), piece
        self.byte_of = {number: byte for byte, number in self.bytes_id.items()}
        if "\n" in self.id_of:
            raise ValueError("a piece holds a line feed")
        self.blank_runs = [p for p in self.id_of if set(p) == {BLANK}]
        if any(BLANK in p.lstrip(BLANK) or (p.startswith(BLANK * 2) and p not in self.blank_runs) for p in self.id_of):
            raise ValueError("a piece crosses the start of a word")
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id_of), None) for p in self.id_of}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            if piece not in self.blank_runs or piece == BLANK:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        single = "".join(p for p in self.id_of if len(p) == 1)
        self.unknown = re.compile(f"[^{re.escape(single)}]")
        self.special = re.compile(f"{BLANK}{BLANK}|{self.unknown.pattern}").search
        self.id_text = {piece: str(number) for piece, number in self.id_of.items()}
        self.fits = Memo(lambda pair: self.merged(pair[0] + pair[1]) == [*pair], most=300_000)
        self.words = Memo(self._word, most=200_000, longest=64)

    def merged(self, text: str) -> list[str]:
        """Merging by definition: the best-scored pair first, of equal ones the leftmost. For short texts."""
        parts = list(text)
        while True:
            scored = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
            if not scored:
                return parts
            at = min(scored)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _blanks(self, n: int) -> list[str]:
        """``n`` blanks merged among themselves. All runs score alike, so the leftmost pair is always next: pairs
        left of the place reached cannot merge, and a merge there is tried again with what stands before it."""
        parts: list[str] = []
        for _ in range(n):
            parts.append(BLANK)
            while len(parts) > 1 and parts[-2] + parts[-1] in self.id_of:
                last = parts.pop()
                parts[-1] += last
        return parts

    def _known(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces, by backtracking."""
        n, shorter, fits = len(text), self.shorter, self.fits
        longest = [0] * (n + 1)
        for end, length in self.automaton.iter(text):  # for one start, a later end is a longer piece
            longest[end - length] = length  # by the place before the start, -1 for the first
        failed, any_failed, found, at, last = b"", False, [], 0, None
        piece = text[: longest[-1]]
        while at < n:
            while piece is not None:
                behind = at + len(piece)
                if (last is None or fits[last, piece]) and not (any_failed and failed[behind >> 3] >> (behind & 7) & 1):
                    break
                piece = shorter[piece]
            if piece is not None:
                found.append(piece)
                last, at = piece, behind
                piece = text[at : at + longest[at - 1]]
                continue
            if not any_failed:
                failed, any_failed = bytearray(n // 8 + 1), True
            failed[at >> 3] |= 1 << (at & 7)
            piece = found.pop()
            at -= len(piece)
            piece, last = shorter[piece], found[-1] if found else None
        return found

    def _word(self, word: str) -> tuple[str, str, int]:
        """The ids of a blank run and the word behind it as text, what they decode to, and their number."""
        if not self.special(word):
            parts = self._known(word)
            return " ".join(map(self.id_text.__getitem__, parts)), "".join(parts).replace(BLANK, " "), len(parts)
        bare = word.lstrip(BLANK)
        blanks = len(word) - len(bare)
        rest = BLANK + bare if blanks and bare else bare
        parts: list[str] = []
        at = 0
        for found in self.unknown.finditer(rest):
            parts += [*self._known(rest[at : found.start()]), found.group()]
            at = found.end()
        parts += self._known(rest[at:])
        if blanks and bare:
            blanks -= 1
            if parts[0] == BLANK:
                blanks, parts = blanks + 1, parts[1:]
        parts = self._blanks(blanks) + parts
        ids = [i for p in parts for i in ([self.id_of[p]] if p in self.id_of else [self.bytes_id[b] for b in p.encode()])]
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def split(self, text: str) -> list[str]:
        """A text with the blank that encoding adds, cut before each run of blanks and around line feeds, which
        are in no piece."""
        out, run = [], BLANK
        for number, line in enumerate(text.replace(" ", BLANK).split("\n")) if text else ():
            if number:
                if run:
                    out.append(run)
                out.append("\n")
                run = ""
            first, *others = line.split(BLANK)
            if first:
                out.append(run + first)
                run = ""
            for word in others:
                run += BLANK
                if word:
                    out.append(run + word)
                    run = ""
        if run and text:
            out.append(run)
        return out

    def decode(self, ids: list[int]) -> str:
        """The pieces' characters and the bytes that stand for others; blanks are spaces. The blank that encoding
        adds is still there; control ids give nothing."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.piece_of.get(number, "") for number in ids]).replace(BLANK, " ")
        out, held = [], bytearray()
        for number in ids:
            if number in self.byte_of:
                held.append(self.byte_of[number])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.piece_of.get(number, ""))
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(BLANK, " ")

    def encode(self, text: str) -> tuple[str, str, int]:
        """Ids with the end id as text, the decoded text, and the number of ids."""
        parts = list(map(self.words.__getitem__, self.split(text)))
        ids = [p[0] for p in parts]
        ids.append(str(self.end_id))
        return " ".join(ids), "".join([p[1] for p in parts])[1:], sum([p[2] for p in parts]) + 1


_MODELS: dict[str, PieceModel] = {}


def piece_model(name: str) -> PieceModel:
    if name not in _MODELS:
        _MODELS[name] = PieceModel(tokenizer_file(name))
    return _MODELS[name]


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", keep: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, end id included; with ``keep`` also
    ``ids`` (decimal, one space between) and ``decoded``.

    A null text is empty: its only id is the end id. Every row is encoded where it is; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_model(model).encode
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            counts, digests, ids, decoded, decoded_digests = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                listed, back, n = encode(text or "")
                counts.append(n)
                digests.append(digest(listed))
                decoded_digests.append(digest(back))
                if keep:
                    ids.append(listed)
                    decoded.append(back)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded_digests)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns, names = [*columns, pa.array(ids), pa.array(decoded)], [*names, "ids", "decoded"]
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts(docs).mapInArrow(run, schema + ", ids string, decoded string" * keep)
