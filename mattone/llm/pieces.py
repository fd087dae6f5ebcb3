"""SentencePiece encoding and decoding as a composition of weighted finite-state transducers.

Three machines are compiled from a model file: the normaliser (a mark before the text, spaces as marks), the
pieces with a byte fallback for characters that no piece spells, and the merge rule.  Composed with an input
they give a lattice whose states are (position, last piece); its path of least weight is the answer.

The model is of the BPE kind, where piece scores order merges and are not additive costs.  The merge rule is
therefore an acceptor over pairs of neighbouring pieces: weight 0 if merging the two spellings from scratch gives
back just these two, infinite otherwise.  A sequence is what merging the whole text gives exactly if all its neighbouring
pairs have weight 0, so one path has finite weight, each position is reached by one
state, and relaxing positions from left to right finds it.

No piece holds a mark after another character, so the lattice falls apart before each such mark, and a
word's path is found once and kept by the worker.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from mattone.llm.arrays import slices

MARK = "▁"
_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Bytes and entries of a worker's stores; a full one is emptied, which costs time and changes no result.
KEPT_BYTES, KEPT_PAIRS = 128 << 20, 500_000
# Bytes of an entry besides its texts, and the longest unit that is kept at all.
ENTRY, LONGEST = 200, 4096
NORMAL, BYTE = 1, 6


@dataclass
class Machine:
    """The compiled model; ``scores`` of normal pieces, ids, and what each id spells.

    ``spelling`` has the pieces as a deterministic machine over characters, a dict per state; the
    key "" of a final state names the piece.
    """

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    spells: list[bytes]
    whole: bool
    prefix: bool
    paths: dict[str, bytes] = field(default_factory=dict)
    n_bytes: int = 0
    pairs: dict[str, dict[str, bool]] = field(default_factory=dict)
    n_pairs: int = 0
    spelling: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Machine:
        """Compile the model file at ``path``, read on the driver."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only BPE models that normalise nothing but spaces are compiled")
        scores, ids, byte_ids, spells = {}, {}, [0] * 256, []
        for i, piece in enumerate(model.pieces):
            text = piece.piece
            if piece.type == NORMAL:
                scores[text], ids[text] = piece.score, i
                spells.append(text.replace(MARK, " ").encode())
            elif piece.type == BYTE:
                byte_ids[int(text[1:-1], 16)] = i
                spells.append(bytes([int(text[1:-1], 16)]))
            else:
                spells.append(b"")
        whole = any(MARK in p.lstrip(MARK) for p in scores)
        return cls(scores, ids, byte_ids, spells, whole, spec.add_dummy_prefix)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "paths": {}, "n_bytes": 0, "pairs": {}, "n_pairs": 0, "spelling": {}}

    def merged(self, text: str) -> list[str]:
        """``text`` merged from its characters: the best-scored pair first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            at, best = -1, float("-inf")
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    at, best = i, score
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: str, right: str) -> bool:
        """Whether the pair has weight 0. An empty ``left`` asks whether ``right`` is what its own spelling merges to."""
        if self.n_pairs >= KEPT_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        weight = self.merged(left + right) == ([left, right] if left else [right])
        self.pairs.setdefault(left, {})[right] = weight
        self.n_pairs += 1
        return weight

    def _compile_spelling(self) -> dict:
        for piece in self.scores:
            state = self.spelling
            for c in piece:
                state = state.setdefault(c, {})
            state[""] = piece
        return self.spelling

    def path(self, unit: str) -> list[str]:
        """The pieces of the one finite path over ``unit``; a character that no piece spells stands for itself."""
        spelling, pairs, size = self.spelling or self._compile_spelling(), self.pairs, len(unit)
        own = pairs.setdefault("", {})
        last: list[str | None] = [None] * (size + 1)
        for begin in range(size):
            before = "" if not begin else last[begin]
            if before is None:
                continue
            known = pairs.get(before)
            if known is None:
                known = pairs[before] = {}
            state, end = spelling, begin
            while end < size:
                state = state.get(unit[end])
                end += 1
                piece = state.get("") if state is not None else None
                if piece is None and end == begin + 1:
                    piece = unit[begin]
                if piece is not None and last[end] is None:
                    weight = known.get(piece)
                    if (self.agree(before, piece) if weight is None else weight) and (not begin or own.get(piece) or piece not in own and self.agree("", piece)):
                        last[end] = piece
                if state is None:
                    break
        out, end = [], size
        while end:
            out.append(last[end])
            end -= len(out[-1])
        return out[::-1]

    def _unit_ids(self, unit: str) -> bytes:
        ids = array("H" if len(self.spells) <= 65536 else "I")
        for piece in self.path(unit):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode())
        return ids.tobytes()

    def encode(self, text: str | None) -> array:
        """Token ids of the whole text; none for a null or empty one."""
        out = array("H" if len(self.spells) <= 65536 else "I")
        if not text:
            return out
        normal = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if self.whole:
            units = [normal]
        else:
            units = normal.split(MARK)
            if units[0] or "" in units[1:]:
                units = _UNITS.findall(normal)
            else:
                units = [MARK + u for u in units[1:]]
        kept = self.paths
        found = [kept.get(u) for u in units]
        if None in found:
            if self.n_bytes >= KEPT_BYTES:
                kept.clear()
                self.n_bytes = 0
            for i, ids in enumerate(found):
                if ids is None:
                    unit = units[i]
                    found[i] = kept.get(unit)
                    if found[i] is None:
                        found[i] = self._unit_ids(unit)
                        if len(unit) <= LONGEST:
                            kept[unit] = found[i]
                            self.n_bytes += ENTRY + len(unit) + len(found[i])
        out.frombytes(b"".join(found))
        return out

    def decode(self, ids: array) -> str:
        """The text that ``ids`` spell; a mark in the input comes back as a space."""
        text = b"".join([self.spells[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_machines: dict[str, Machine] = {}


def _own(key: str, machine: Machine) -> Machine:
    """The worker's machine of that name, so that paths found by one task serve the next."""
    return _machines.setdefault(key, machine)


def encode(documents: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids: array<int>, n_tokens) of every row's whole text.

    Null and empty texts have no ids; a null doc_id is kept; repeated rows are encoded each; an empty table gives an
    empty result; other columns are ignored.
    """
    machine = Machine.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(model_path, machine)
        for piece in slices(batches):
            ids = [own.encode(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "ids", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, n_tokens long")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of every row of ``encoded(doc_id, ids)``; null ids give an empty text."""
    machine = Machine.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [machine.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, restored) of every row: its ids counted and summed up, and whether they give the text back."""
    machine = Machine.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(model_path, machine)
        for piece in slices(batches):
            n, crc, same = [], [], []
            for text in piece.column("text").to_pylist():
                ids = own.encode(text)
                n.append(len(ids))
                crc.append(zlib.crc32(array("I", ids).tobytes()))
                same.append(own.decode(ids) == (text or "").replace(MARK, " "))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids_crc32", "restored"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, restored boolean")
