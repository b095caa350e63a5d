"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they would make (ties: the leftmost).
The best pair is merged and its new neighbours enter the agenda, until no pair makes a piece; what is no piece then falls
back to bytes. A merge can't cross two characters that stand side by side in no piece. If the vocabulary shows that of a
space mark after anything else, and of letters beside ASCII marks or line ends, texts are cut there: the agenda runs on
each part alone, and the outcomes of the first KEPT_PARTS parts are kept for the life of the Python worker. For other
vocabularies it runs on whole texts.

Decoding puts the bytes of the ids' pieces together. That is done for each part when it is encoded: a part whose ids' bytes
are its own decodes to itself, and a text of such parts too; other texts are put together from what their parts decode to.

The outcome is checked against the sentencepiece library in Arrow batches: every whole text is encoded and decoded by both.
What is returned is the agenda's; ``agrees`` says whether the library has the same ids and decoded text, and where it
hasn't, its own are returned.

Models with a normalisation table, unigram models and models with user-defined pieces are refused with a ValueError.

Defined results: null or empty text: no ids, empty decoded text; repeated rows are encoded each; an empty table gives no
rows; other input columns are left out; doc_id may be null. Rows never meet, so there is no shuffle and no skew.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import ready, text_of

SPACE = "▁"
LETTERS, MARKS, ENDS = r"[^\W_¹²³]", r"!-/:-@\[-`{-~", r"\n"  # small raised figures stand beside marks in some pieces
#: Spaces with letters up to a mark, marks up to letters, line ends; else all up to a space.
PARTS = re.compile(
    f"{SPACE}*+{LETTERS}++(?=[{MARKS}{ENDS}{SPACE}]|\\Z)|{SPACE}*+[{MARKS}]++(?={LETTERS}|[{ENDS}{SPACE}]|\\Z)"
    f"|{SPACE}*+[{ENDS}]++(?={LETTERS}|[{MARKS}{SPACE}]|\\Z)|{SPACE}*[^{SPACE}]+|{SPACE}+"
)
KEPT_PARTS, KEPT_CHARS = 600_000, 40
#: Symbols up to which the agenda is a plain list, which is faster than a heap there.
SHORT = 40


def kind(c: str) -> int:
    return 0 if re.match(LETTERS, c) else 1 if re.match(f"[{MARKS}]", c) else 2 if c == "\n" else 3


class Parts(dict[str, bytes]):
    """Outcomes of parts, worked out when they are first asked for. What is too long, or more than KEPT_PARTS, is held in brief
    until that is cleared."""

    def __init__(self, work: Callable[[str], bytes]):
        self.work, self.brief = work, {}

    def __missing__(self, part: str) -> bytes:
        if (found := self.brief.get(part)) is None:
            found = self.work(part)
            held = self if len(part) <= KEPT_CHARS and len(self) < KEPT_PARTS else self.brief
            held[part] = found
        return found


class Agenda:
    """Encoder and decoder over the pieces of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = model.SentencePiece
        if model.trainer_spec.model_type != 2 or model.normalizer_spec.precompiled_charsmap or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces) or not model.normalizer_spec.escape_whitespaces or model.normalizer_spec.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models without normalisation or user-defined pieces")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        self.score = {p.piece: (-p.score, k) for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        #: id to its UTF-8 bytes, for decoding; controls decode to nothing, the unknown piece to the library's surface.
        self.surface = [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        for b, k in self.bytes.items():
            self.surface[k] = bytes([b])
        for k, p in enumerate(model.pieces):
            if p.type == kinds.CONTROL:
                self.surface[k] = b""
            elif p.type == kinds.UNKNOWN:
                self.surface[k] = model.trainer_spec.unk_surface.encode()
        scores = sorted({x for x, _ in self.score.values()})
        order = {x: k for k, x in enumerate(scores)}
        self.rank = {p: order[x] for p, (x, _) in self.score.items()}
        beside = {(kind(a), kind(b)) for p in self.score for a, b in zip(p, p[1:], strict=False) if SPACE not in (a, b)}
        crossing = {(a, b) for a in range(3) for b in range(3) if a != b} & beside
        self.by_part = self.prefix == SPACE and not crossing and not any(SPACE in p.lstrip(SPACE) for p in self.score)
        #: Comma-joined ids of a part, and what they decode to; the parts that don't decode to themselves.
        self.table = Parts(self.of_part)
        self.plain_of: dict[str, bytes] = {}
        self.unlike: set[str] = set()
        self.seen = self.missed = 0
        self.digits = [str(k) for k in range(len(model.pieces))]

    def merge(self, text: str) -> list[int]:
        """Ids of one part by the agenda. An entry is the rank of a piece and the place of its left symbol, in one number."""
        rank, symbols = self.rank.get, list(text)
        n = len(symbols)
        if n <= SHORT:
            return self.ids(self.merge_short(symbols))
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            best = heapq.heappop(agenda)
            a = best & 0xFFFFFFFF
            b = right[a]
            if not symbols[a] or b >= n or rank(piece := symbols[a] + symbols[b]) != best >> 32:
                continue  # one of the two has been merged meanwhile
            symbols[a], symbols[b] = piece, ""
            right[a] = c = right[b]
            if c < n:
                left[c] = a
                if (r := rank(piece + symbols[c])) is not None:
                    heapq.heappush(agenda, r << 32 | a)
            if (p := left[a]) >= 0 and (r := rank(symbols[p] + piece)) is not None:
                heapq.heappush(agenda, r << 32 | p)
        return self.ids(symbols)

    def merge_short(self, symbols: list[str]) -> list[str]:
        """The pieces of few symbols: their agenda is a list of ranks by place."""
        rank, none = self.rank.get, len(self.rank)
        agenda = [rank(a + b, none) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        while agenda and (best := min(agenda)) < none:
            a = agenda.index(best)
            symbols[a] += symbols.pop(a + 1)
            del agenda[a]
            if a < len(agenda):
                agenda[a] = rank(symbols[a] + symbols[a + 1], none)
            if a:
                agenda[a - 1] = rank(symbols[a - 1] + symbols[a], none)
        return symbols

    def ids(self, symbols: list[str]) -> list[int]:
        """Ids of the pieces that are left, in bytes where there is no piece."""
        ids: list[int] = []
        for s in symbols:
            if s in self.score:
                ids.append(self.score[s][1])
            elif s and self.bytes:
                ids += [self.bytes[x] for x in s.encode()]
            elif s:
                ids.append(self.unknown)
        return ids

    def parts(self, text: str) -> list[str]:
        """The parts of a text, or the text as one; with the prefix and with marks for spaces."""
        if not text:
            return []
        text = self.prefix + text.replace(" ", SPACE)
        return PARTS.findall(text) if self.by_part else [text]

    def of_part(self, part: str) -> bytes:
        """Comma-joined ids of a part that the table doesn't hold; notes what they decode to, and if that isn't the part."""
        ids = self.merge(part)
        self.missed += 1
        self.plain_of[part] = plain = self.decoded(ids)
        if plain != part.replace(SPACE, " ").encode():
            self.unlike.add(part)
        return ",".join([self.digits[i] for i in ids]).encode()

    def of_texts(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Comma-joined ids and decoded text of each, by the agenda alone."""
        table, out = self.table, []
        for text in texts:
            parts = self.parts(text)
            self.seen += len(parts)
            ids = b",".join(map(table.__getitem__, parts))
            if self.unlike and not self.unlike.isdisjoint(parts):
                plain = self.plain(b"".join(map(self.plain_of.__getitem__, parts)))
            else:  # every part decodes to itself, and so does the text
                plain = text.replace(SPACE, " ")
            out.append((ids, plain))
        for p in table.brief:
            del self.plain_of[p]
        self.unlike.difference_update(table.brief)
        table.brief.clear()
        if len(table) >= KEPT_PARTS and self.seen > 1_000_000:
            # what comes early is mostly what is common, so a full table stays - unless the texts have changed
            if self.missed > 0.2 * self.seen:
                table.clear()
                self.plain_of.clear()
                self.unlike.clear()
            self.seen = self.missed = 0
        return out

    def by_library(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """The same by the library."""
        ids = self.library.encode(texts, num_threads=1)
        digits = self.digits
        return [(",".join([digits[i] for i in x]).encode(), d) for x, d in zip(ids, self.library.decode(ids, num_threads=1), strict=True)]

    def plain(self, whole: bytes) -> str:
        """Decoded bytes as text, without the space that the prefix stands for."""
        return (whole[1:] if self.prefix and whole[:1] == b" " else whole).decode("utf-8", "replace")

    def decoded(self, ids: list[int]) -> bytes:
        """The bytes of the ids' pieces."""
        return b"".join([self.surface[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.plain(self.decoded(ids))


_OPEN: dict[str, Agenda] = {}


def opened(path: str) -> Agenda:
    """One per Python worker and file."""
    if path not in _OPEN:
        _OPEN[path] = Agenda(path)
    return _OPEN[path]


def tokens(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """doc_id, ids, decoded, agrees (null without the check against the library)."""
    return _run(docs, model, check, False)


def op4(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, agrees."""
    return _run(docs, model, check, True)


def _run(docs: DataFrame, model: str, check: bool, digests: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = opened(model)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                found = agenda.of_texts(texts)
                agrees: list[bool | None] = [None] * len(texts)
                if check:
                    theirs = agenda.by_library(texts)
                    agrees = [x == y for x, y in zip(found, theirs, strict=True)]
                    found = [x if same else y for x, y, same in zip(found, theirs, agrees, strict=True)]
                n = pa.array([ids.count(b",") + bool(ids) for ids, _ in found], pa.int64())
                if digests:
                    sha = lambda raws: pa.array([hashlib.sha256(x).hexdigest() for x in raws], pa.string())
                    cols, names = [n, sha(ids for ids, _ in found), sha(d.encode() for _, d in found)], ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    ids = pa.array([[int(x) for x in ids.split(b",") if x] for ids, _ in found], pa.list_(pa.int32()))
                    cols, names = [ids, pa.array([d for _, d in found], pa.string())], ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols, pa.array(agrees, pa.bool_())], names=["doc_id", *names, "agrees"])

    ready(docs.sparkSession)
    middle = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, f"doc_id long, {middle}, agrees boolean")
