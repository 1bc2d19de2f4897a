"""Texts over a size limit into pieces at natural boundaries.

A text is seen as units: words with the white space before them. They lie where the vocabulary's pattern cuts whatever is
around, so the tokens of units add up exactly. A word that alone is long is merged once and cut at its own tokens.

Texts of more than one range of characters, and files, are worked on in ranges with halos. Workers find the units that
begin in their range; these tables, no texts, are brought together by text, local offsets become offsets of the text by
running sums of the ranges' lengths, and walking through the units gives each piece's offsets, which go back to the ranges
they touch, where pieces are cut out. What is a unit depends on HALO characters around it only, so the ranges' width makes
no difference to the pieces.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.functions.common import partitions, ship, spread
from vintara.llm.bpe import Encoder, encoder, pieces_of

#: Kinds of boundary, the more natural the higher: within a word; between words that no space parts; and so on.
KINDS = ("hard", "part", "word", "sentence", "item", "paragraph", "end")
HARD, PART, WORD, SENTENCE, ITEM, PARAGRAPH, END = range(7)

_ITEM = re.compile(r"\s*(?:\*{0,2}[(\[]?(?:\d{1,4}|[a-zA-Z]|[IVXLC]{1,6})[.)\]*]|[-•–§*])")
#: Within a line an item's mark needs a stop or parenthesis and a capital after it.
_INLINE = re.compile(r"\s*\*{0,2}(?:[(\[](?:\d{1,4}|[a-zA-Z]|[IVXLC]{1,6})[)\]]|(?:\d{1,4}|[a-zA-Z]|[IVXLC]{1,6})[.)])\*{0,2}\s+[\"'“„«(\[]?(\w)")
_SENTENCE = re.compile(r"(?:(\w+)|[)\]\"'”»«])([.!?…]+)[)\]\"'”»]*\Z")
#: Words whose stop ends no sentence, as do those of single letters, short numbers and Roman numerals. Shorter than BACK.
_SHORT = frozenset(
    """vgl az nr nrn no nos art arts abs ziff lit let rn rz rdn rdnr ff al bzw ca bd hrsg hg urt beschl entsch slg anm aufl abschn allg bes bgbl ggf insb inkl evtl
    sog str tel cf eg ie vs mr mrs ms dr prof jr sr st inc ltd co corp pp para paras sec secs sect ch chap vol ed eds op cit ibid id fig app reg regs cl pt dept
    gov gen hon rev univ assn bros supp cir dist ct ex par consid erw mm mme mlle préc éd req obs comm bull civ crim cass trib cie sté resp
    jan feb mar apr jun jul aug sep sept oct okt nov dec dez janv févr avr juil déc""".split()
)
_ROMAN = re.compile(r"[IVXLC]+")
#: Characters before a boundary that tell whether a sentence ends there.
BACK = 16
#: Of a character's code: 1 if it ends a line, 2 if it may close a sentence; the last place holds for all codes beyond.
_SIGNS = np.zeros(0x202B, np.int8)
_SIGNS[[10, 13, 0x2028, 0x2029]] = 1
_SIGNS[[ord(c) for c in ".!?…)]\"'”»"]] = 2


def _ends_sentence(text: str, p: int) -> bool:
    stop = text[p - 1]
    if stop == ".":
        q = max(text.rfind(" ", max(0, p - BACK), p - 1) + 1, p - BACK, 0)
        word = text[q : p - 1]
        if word.isalnum():  # the usual case: a word and its stop
            return _no_abbreviation(word)
    m = _SENTENCE.search(text, max(0, p - BACK), p)
    return bool(m) and (m[1] is None or m[2] != "." or _no_abbreviation(m[1]))


def _no_abbreviation(word: str) -> bool:
    if word.isdigit():  # shorter ones are ordinals and items' marks
        return len(word) >= 4
    return len(word) > 1 and word.lower() not in _SHORT and not _ROMAN.fullmatch(word)


def units(text: str, skip: int, own: int, hard: int, enc: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of text[skip : skip + own] within its halo: places (in text) at which units begin, their tokens, WORD or PART, and
    the texts of long words, i.e. those of more than `hard` bytes, as far as they lie in the range. Long words have -1 for
    tokens; -2 at the range's first place goes on with the word of the range before."""
    parts = pieces_of(text)
    sizes = np.fromiter(map(enc.sizes.__getitem__, parts), np.int64, len(parts))
    lengths = sizes & 511
    for k in np.flatnonzero(sizes == 0).tolist():
        lengths[k] = len(parts[k])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    a, b = np.searchsorted(ends, skip, "right"), np.searchsorted(starts, skip + own)
    parts, sizes, starts = parts[a:b], sizes[a:b], starts[a:b]
    more: list[tuple[int, int, int]] = []
    words: list[str] = []
    plain, n = starts >= skip, sizes >> 18
    for k in np.flatnonzero((sizes == 0) | (sizes >> 9 & 511 > hard)).tolist():
        piece = parts[k]
        if len(piece.encode("utf-8", "surrogatepass")) <= hard:
            n[k] = enc.size(piece)
            continue
        plain[k] = False
        found = enc.find(piece)
        if len(found) > 1 and found[0].isspace():  # at a text's end this space would join those before it
            found[:2] = [found[0] + found[1]]
        at = int(starts[k])
        for j, w in enumerate(found):
            end = at + len(w)
            if end > skip and at < skip + own:
                if len(w.encode("utf-8", "surrogatepass")) > hard:
                    more.append((max(at, skip), -1 if at >= skip else -2, PART if j else WORD))
                    words.append(text[max(at, skip) : min(end, skip + own)])
                elif at >= skip:
                    more.append((at, enc.sizes[w] >> 18 or enc.size(w), PART if j else WORD))
            at = end
    at, n, kinds = starts[plain], n[plain], np.full(int(plain.sum()), WORD, np.int64)
    if more:
        extra = np.array(more, np.int64)
        at, n, kinds = (np.concatenate((x, extra[:, c])) for c, x in enumerate((at, n, kinds)))
        order = np.argsort(at, kind="stable")
        at, n, kinds = at[order], n[order], kinds[order]
    return at, n, kinds, words


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def natural(text: str, codes: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Kinds with sentences, items and paragraphs told."""
    lines, closed = _candidates(codes, at, kinds)
    kinds = kinds.copy()
    for i, p in zip(closed.tolist(), at[closed].tolist()):
        if not _ends_sentence(text, p):
            continue
        if _inline_item(text, p):
            kinds[i] = ITEM
        elif _begins_sentence(text, p):
            kinds[i] = SENTENCE
    for i, p in zip(lines.tolist(), at[lines].tolist()):
        if _ends_paragraph(text, p):
            kinds[i] = PARAGRAPH
        else:
            kinds[i] = ITEM if _ITEM.match(text, p, p + 12) else SENTENCE
    return kinds


def _candidates(codes: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which units begin with the end of a line; and which others come after what may close a sentence."""
    word = kinds == WORD
    line = word & (_SIGNS[np.minimum(codes[at], len(_SIGNS) - 1)] == 1)
    closed = word & ~line & (at > 0) & (_SIGNS[np.minimum(codes[at - 1], len(_SIGNS) - 1)] == 2)
    return np.flatnonzero(line), np.flatnonzero(closed)


def _inline_item(text: str, p: int) -> bool:
    item = text[p].isspace() and _INLINE.match(text, p, p + 24)
    return bool(item) and item[1].isupper()


def _begins_sentence(text: str, p: int) -> bool:
    nxt = text[p + 1 : p + 2]
    return not nxt.islower() and not nxt.isdigit()


def _ends_paragraph(text: str, p: int) -> bool:
    return p > 0 and text[p - 1].isspace() and "\n" in text[max(0, p - 4) : p]


def most_natural(text: str, codes: np.ndarray, at: np.ndarray, kinds: np.ndarray):
    """tell(a, z): (place after a, kind) of the last of the most natural boundaries among units a to z, as natural() has
    them. It looks from the end, and no further than the answer needs."""
    lines, closed = (x.tolist() for x in _candidates(codes, at, kinds))

    def tell(a: int, z: int) -> tuple[int, int]:
        mine = lines[bisect_left(lines, a) : bisect_left(lines, z)]
        for i in reversed(mine):
            if _ends_paragraph(text, int(at[i])):
                return i - a, PARAGRAPH
        best, kind = (mine[-1], SENTENCE) if mine else (-1, WORD)
        for i in reversed(mine):
            p = int(at[i])
            if _ITEM.match(text, p, p + 12):
                best, kind = i, ITEM
                break
        for i in reversed(closed[bisect_left(closed, a) : bisect_left(closed, z)]):
            if kind == ITEM and i < best:
                break
            p = int(at[i])
            if _inline_item(text, p):
                if _ends_sentence(text, p):
                    best, kind = i, ITEM
                    break
            elif kind != ITEM and i > best and _begins_sentence(text, p) and _ends_sentence(text, p):
                best, kind = i, SENTENCE
        if kind == WORD:
            last = kinds[a:z]
            best = z - 1 - int(np.argmax(last[::-1]))
            kind = int(kinds[best])
        return best - a, kind

    return tell


#: Columns of a range besides its text's key; none is null, so joins put no filter below the shuffle, which both its readers share.
RANGE = "h binary not null, i bigint not null, skip int not null, own int not null, t string not null"


class _Word:
    """A long word, or what is left of it. ends, whole: the characters up to the end of each token of text[:width], and
    whether that lies between two characters. Tokens never merge over an end, so those of a part of the word that begins
    and ends at such places are the ones in between, and the word need not be merged again for it."""

    __slots__ = ("cut", "ends", "fresh", "text", "whole", "width")

    def __init__(self, text: str):
        self.text, self.cut, self.width, self.fresh = text, False, 0, False
        self.ends = self.whole = np.zeros(0, np.int64)

    def merge(self, text: str, enc: Encoder) -> None:
        ends, data = np.cumsum(enc.lengths[np.frombuffer(enc.encode(text), np.int32)]), text.encode("utf-8", "surrogatepass")
        if len(data) == len(text):
            self.ends, self.whole = ends, np.ones(len(ends), bool)
        else:
            begins = np.append(np.frombuffer(data, np.uint8) & 0xC0 != 0x80, True)
            self.ends, self.whole = np.cumsum(begins)[ends - 1], begins[ends]
        self.width, self.fresh = len(text), True

    def drop(self, begin: int) -> None:
        k = int(np.searchsorted(self.ends, begin, "right"))
        held = k and self.ends[k - 1] == begin and self.whole[k - 1]
        self.text, self.cut, self.fresh = self.text[begin:], True, False
        self.ends, self.whole, self.width = (self.ends[k:] - begin, self.whole[k:], self.width - begin) if held else (self.ends[:0], self.whole[:0], 0)


class Planner:
    """Walks through one text's units in order and gives pieces as (begin, end, tokens, kind of the end). It holds the
    units of the present piece and of what was fed last; of a word without end no more than a piece can take."""

    def __init__(self, limit: int, overlap: int, enc: Encoder, tell=None):
        """tell: what most_natural() gives for the text's units in order; without it the kinds fed are those of natural()."""
        self.limit, self.overlap, self.hard, self.enc = limit, overlap, limit // 8, enc
        self.need = max((limit + 1) // 2, overlap + self.hard + 1)  # tokens from which a piece may end
        self.reach = limit * enc.longest  # more bytes than these are surely more tokens than the limit
        self.at = self.n = self.kind = np.zeros(0, np.int64)
        self.words: dict[int, _Word] = {}  # by place
        self.open = False  # whether the last unit is a word that may go on
        self.pieces: list[tuple[int, int, int, int]] = []
        self.tell, self.dropped = tell, 0

    def _beyond(self, word: str) -> bool:
        """Whether a word surely has more tokens than the limit, however it goes on."""
        return len(word) > self.reach or 4 * len(word) > self.reach and len(word.encode("utf-8", "surrogatepass")) > self.reach

    def _told(self, m: int) -> _Word:
        """Long word m, which has ended or is beyond reach, with its tokens: all of them, or more than a piece can take.
        What is merged depends on the word alone, not on how much of it was fed."""
        w = self.words[m]
        if not w.fresh and w.width < len(w.text) and len(w.ends) <= self.limit + self.hard or not w.width:
            w.merge(w.text[: self.reach // 4], self.enc)
            if w.width < len(w.text) and len(w.ends) <= self.limit + self.hard:
                data, e = w.text[: self.reach + 1].encode("utf-8", "surrogatepass"), self.reach
                while e < len(data) and data[e] & 0xC0 == 0x80:
                    e -= 1
                w.merge(data[:e].decode("utf-8", "surrogatepass"), self.enc)
        return w

    def _size(self, m: int) -> int:
        """Tokens of long word m; of one over the limit only that it is."""
        return self.limit + 1 if self._beyond(self.words[m].text) else min(len(self._told(m).ends), self.limit + 1)

    def feed(self, at: np.ndarray, n: np.ndarray, kind: np.ndarray, words: list[str], ended: bool) -> None:
        """Units in order. ended: whether the last word, if long, is known to end."""
        words = iter(words)
        if len(n) and n[0] == -2:
            self.words[len(self.at) - 1].text += next(words)
            at, n, kind = at[1:], n[1:], kind[1:]
            if len(n):
                self._close()
        elif len(n):
            self._close()
        first = len(self.at)
        self.at, self.n, self.kind = np.concatenate((self.at, at)), np.concatenate((self.n, n)), np.concatenate((self.kind, kind))
        for k in (np.flatnonzero(n == -1) + first).tolist():
            self.words[k] = _Word(next(words))
            self.n[k] = self.limit + 1
            if k < len(self.at) - 1:
                self.n[k] = self._size(k)
        self.open = len(self.at) - 1 in self.words
        if ended:
            self._close()

    def _close(self) -> None:
        if self.open:
            self.n[-1] = self._size(len(self.n) - 1)
        self.open = False

    def _drop(self, u: int, begin: int = 0) -> None:
        """Forget the units before u and so much of u, a long word."""
        if u or begin:
            self.dropped += u
            self.at, self.n, self.kind = self.at[u:].copy(), self.n[u:].copy(), self.kind[u:]
            self.words = {k - u: w for k, w in self.words.items() if k >= u}
        if begin:
            self.words[0].drop(begin)
            self.at[0] += begin
            self.n[0] = self.limit + 1 if self.open and len(self.at) == 1 else self._size(0)

    def _cut_in(self, m: int, budget: int) -> tuple[int, int]:
        """(j, tokens of word[:j]) with at most budget tokens, at the end of one of its tokens."""
        w = self._told(m)
        for t in range(min(budget, len(w.ends)), 0, -1):
            if w.whole[t - 1]:
                j = min(int(w.ends[t - 1]), len(w.text) - 2)
                n = t if j == w.ends[t - 1] else self.enc.size(w.text[:j])
                if j >= 2 and n <= budget:
                    return j, n
        raise ValueError("no place to cut a word")

    def _start_in(self, m: int, end: int, need: int) -> int:
        """Where unit m, a long word, is to begin so that the last need tokens up to word[end] are kept: at one of its
        tokens; if it must, at its own beginning, or where m begins the present piece, just behind."""
        w = self._told(m)
        least = 1 if w.cut else 2
        if need <= 0:
            return max(end, least)
        t = int(np.searchsorted(w.ends, end, "right")) - 1
        if t < 0 or w.ends[t] != end or not w.whole[t]:  # the end is none of the word's tokens'
            w = _Word(w.text)
            w.merge(w.text[:end], self.enc)
            t = len(w.ends) - 1
        for b in range(t - need, -1, -1):
            i = int(w.ends[b])
            if i < least:
                break
            if w.whole[b] and i <= len(w.text) - 2:
                return i
        return 0 if m else least

    def _back(self, cum: np.ndarray, k: int, need: int) -> None:
        """The next piece begins at the last boundary that has need tokens from there up to unit k."""
        m = max(int(np.searchsorted(cum, cum[k] - need, "right")) - 1, 0)
        if m < k and m in self.words and (self.n[m] > self.hard or m == 0):
            self._drop(m, self._start_in(m, len(self.words[m].text), int(need - (cum[k] - cum[m + 1]))))
            return
        while m > 1 and self.kind[m] == PART and m - 1 not in self.words and cum[k] - cum[m - 1] <= need + self.hard:
            m -= 1
        self._drop(max(m, 1))

    def advance(self) -> None:
        """All pieces that are certain by now."""
        while len(self.at):
            known = len(self.at) - (self.open and not self._beyond(self.words[len(self.at) - 1].text))
            cum = np.concatenate(([0], np.cumsum(self.n[:known])))
            u = 0
            while True:  # as long as pieces begin and end between units
                e = int(np.searchsorted(cum, cum[u] + self.limit, "right")) - 1
                if e >= known:
                    self._drop(u)
                    return
                low = max(int(np.searchsorted(cum, cum[u] + self.need)), u + 1)
                if low > e:
                    break
                if self.tell:
                    k, kind = self.tell(self.dropped + low, self.dropped + e + 1)
                    k += low
                else:
                    k = e - int(np.argmax(self.kind[low : e + 1][::-1]))
                    kind = int(self.kind[k])
                self.pieces.append((int(self.at[u]), int(self.at[k]), int(cum[k] - cum[u]), kind))
                m = int(np.searchsorted(cum, cum[k] - self.overlap, "right")) - 1
                if self.words or self.kind[m] == PART or m <= u:
                    self._drop(u)
                    self._back(cum[u:], k - u, self.overlap)
                    u = -1
                    break
                u = m
            if u < 0:
                continue
            self._drop(u)  # no boundary leaves the piece long enough: the next unit is a long word
            cum, e = cum[u:] - cum[u], e - u
            j, n = self._cut_in(e, int(self.limit - cum[e]))
            self.pieces.append((int(self.at[0]), int(self.at[e]) + j, int(cum[e]) + n, HARD))
            if n >= self.overlap:
                self._drop(e, self._start_in(e, j, self.overlap))
            else:
                self._back(cum, e, self.overlap - n)

    def end(self, length: int) -> list[tuple[int, int, int, int]]:
        self._close()
        self.advance()
        if len(self.at):
            self.pieces.append((int(self.at[0]), length, int(self.n.sum()), END))
        self.at = self.at[:0]
        return self.pieces


def _checked(limit: int, overlap: int) -> tuple[int, int]:
    if limit < 64 or not 0 <= overlap <= limit // 2:
        raise ValueError("limit must be at least 64, overlap within half of it")
    return limit // 8, limit // 8 + BACK  # bytes of a word that is no long one; characters of a halo


def split_texts(documents: DataFrame, limit: int, overlap: int, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", span: int = 1 << 14) -> DataFrame:
    """(key, piece, begin, end, n_tokens, cut, text): each text's pieces in order, by character offsets.

    n_tokens is what the tokenizer gives for the piece's text, at most limit. A text of at most `limit` tokens is one
    piece. Otherwise a piece ends at the most natural boundary that leaves it at least half full (paragraph, numbered item
    or line, sentence, between words), of those the last; only where there is none, within a long word (over limit / 8
    bytes). The next begins at the last boundary that is at least `overlap` tokens before, within a long word if it must.
    Pieces cover the text without gaps. An empty or null text has no piece. A repeated row gives its pieces again; texts
    of one key, null too, are cut apart. Other columns are not read. limit < 64 or overlap outside [0, limit / 2] raise
    ValueError. Pieces do not depend on `span`, the characters of a range.

    Texts of one range are cut where they are read. Longer ones are cut up in one pass, their ranges spread over all tasks.
    """
    hard, halo = _checked(limit, overlap)
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    rows = spread(documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t")))
    out = f"key {kind}, piece int, begin bigint, end bigint, n_tokens int, cut string, text string"

    def whole(batches):
        enc = encoder(vocabulary)
        for b in batches:
            got: list[tuple] = []
            source: list[int] = []
            for r, t in enumerate(b.column("t").to_pylist()):
                at, n, kinds, words = units(t, 0, len(t), hard, enc)
                if not words and n.sum() <= limit:
                    got.append((0, 0, len(t), int(n.sum()), KINDS[END], t))
                    source.append(r)
                    continue
                planner = Planner(limit, overlap, enc, most_natural(t, codes_of(t), at, kinds))
                planner.feed(at, n, kinds, words, True)
                for k, (begin, end, size, how) in enumerate(planner.end(len(t))):
                    got.append((k, begin, end, size, KINDS[how], t[begin:end]))
                    source.append(r)
            kinds_ = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(source, pa.int64())), *[pa.array([g[c] for g in got], x) for c, x in enumerate(kinds_)]], names=["key", "piece", "begin", "end", "n_tokens", "cut", "text"])

    def ranged(batches):
        for b in batches:
            for r, t in enumerate(b.column("t").to_pylist()):
                h = hashlib.blake2b(f"{b.column('key')[r].as_py()!r}:{len(t)}:".encode("utf-8", "surrogatepass") + t.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                every = range(0, len(t), span)
                for some in (every[x : x + 64] for x in range(0, len(every), 64)):
                    skip = [min(a, halo) for a in some]
                    data = [pa.array([h] * len(some), pa.binary()), pa.array([a // span for a in some], pa.int64()), pa.array(skip, pa.int32()), pa.array([min(span, len(t) - a) for a in some], pa.int32()), pa.array([t[a - s : a + span + halo] for a, s in zip(some, skip)])]
                    yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array([r] * len(some), pa.int64())), *data], names=["key", "h", "i", "skip", "own", "t"])

    short = rows.where(F.length("t").between(1, span)).mapInArrow(whole, out)
    ranges = rows.where(F.length("t") > span).mapInArrow(ranged, f"key {kind}, {RANGE}")
    long = _from_ranges(ranges.repartition(partitions(documents), "h", "i"), limit, overlap, vocabulary)
    return short.unionByName(long).withColumnRenamed("key", key)


def split_files(spark: SparkSession, path: str, limit: int, overlap: int, vocabulary: str = "byte_bpe_50k", span: int = 1 << 16) -> DataFrame:
    """(path, piece, begin, end, n_tokens, cut, text) of text files in UTF-8, as split_texts has it: begin and end count
    characters. Workers read their own ranges of bytes (any file system that pyarrow knows), twice, and no file is read
    as a whole; only the files' names and sizes are listed. Bytes that are no UTF-8 become U+FFFD."""
    hard, halo = _checked(limit, overlap)
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    listed = files.select(F.col("path").alias("key"), F.unhex(F.md5("path")).alias("h"), "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / span))).alias("i"))

    def read(batches):
        for b in batches:
            rows = []
            for key, h, size, i in zip(*(b.column(c).to_pylist() for c in ("key", "h", "size", "i"))):
                system, name = pyarrow.fs.FileSystem.from_uri(key) if urlsplit(key).scheme not in ("", "file") else (pyarrow.fs.LocalFileSystem(), unquote(urlsplit(key).path))
                begin, end = i * span, min((i + 1) * span, size)
                first, last = max(0, begin - 4 * halo), min(size, end + 4 * halo + 4)
                with system.open_input_file(name) as f:
                    f.seek(first)
                    data = f.read(last - first)
                # A character belongs to the range of its first byte.
                a, z = (next((p for p in range(x - first, min(x - first + 4, len(data))) if data[p] & 0xC0 != 0x80), min(x - first, len(data))) if 0 < x < size else x - first for x in (begin, end))
                before, mine, after = (x.decode("utf-8", "replace") for x in (data[:a], data[a:z], data[z:]))
                skip = min(len(before), halo)
                rows.append((key, h, i, skip, len(mine), before[len(before) - skip :] + mine + after[:halo]))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], x) for c, x in enumerate((pa.string(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=["key", "h", "i", "skip", "own", "t"])

    ranges = listed.repartition(partitions(files), "h", "i").mapInArrow(read, f"key string, {RANGE}")
    return _from_ranges(ranges, limit, overlap, vocabulary).withColumnRenamed("key", "path")


def _from_ranges(ranges: DataFrame, limit: int, overlap: int, vocabulary: str) -> DataFrame:
    """Pieces of texts given as ranges: key, h (tells texts apart), i, skip (characters of the halo before), own, t."""
    hard = limit // 8

    def detect(batches):
        enc = encoder(vocabulary)
        seen: set = set()  # equal rows lie in one task: their units are told once
        for b in batches:
            got, of = [], []
            for r, (h, i, skip, own, t) in enumerate(zip(*(b.column(c).to_pylist() for c in ("h", "i", "skip", "own", "t")))):
                if (h, i) in seen:
                    continue
                seen.add((h, i))
                at, n, kinds, words = units(t, skip, own, hard, enc)
                got.append((at - skip, n, natural(t, codes_of(t), at, kinds), words))
                of.append(r)
            lists = [pa.array([g[c] for g in got], pa.list_(x)) for c, x in enumerate((pa.int32(), pa.int32(), pa.int8(), pa.string()))]
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(of) for c in ("h", "i", "own")], *lists], names=["h", "i", "own", "at", "n", "kind", "words"])

    def plan(batches):
        enc = encoder(vocabulary)
        now = planner = None
        base: list[int] = []  # offset of each range still in use, and the next
        first = number = 0
        rows: list[tuple] = []

        def put():
            nonlocal first, number
            for begin, end, size, how in planner.pieces:
                while len(base) > 1 and base[1] <= begin:
                    base.pop(0)
                    first += 1
                k = 0
                while base[k] < end:
                    rows.append((now, number, begin, end, size, KINDS[how], first + k, max(begin, base[k]) - base[k], min(end, base[k + 1]) - base[k]))
                    k += 1
                number += 1
            planner.pieces.clear()

        def taken():
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32())
            out = pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], x) for c, x in enumerate(kinds)], names=["h2", "piece", "begin", "end", "n_tokens", "cut", "i2", "lo", "hi"])
            rows.clear()
            return out

        for b in batches:
            for r, (h, own) in enumerate(zip(b.column("h").to_pylist(), b.column("own").to_pylist())):
                if h != now:
                    if planner is not None:
                        planner.end(base[-1])
                        put()
                    now, planner, base, first, number = h, Planner(limit, overlap, enc), [0], 0, 0
                at, n, kinds = (b.column(c)[r].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n", "kind"))
                planner.feed(at + base[-1], n, kinds, b.column("words")[r].as_py(), False)
                base.append(base[-1] + own)
                planner.advance()
                put()
            yield taken()
        if planner is not None:
            planner.end(base[-1])
            put()
            yield taken()

    tables = ranges.mapInArrow(detect, "h binary, i bigint, own int, at array<int>, n array<int>, kind array<tinyint>, words array<string>")
    planned = tables.repartition("h").sortWithinPartitions("h", "i").mapInArrow(plan, "h2 binary, piece int, begin bigint, end bigint, n_tokens int, cut string, i2 bigint, lo int, hi int")
    # All columns of the ranges are used here as above, own too, so that both read one and the same shuffle.
    held = ranges.join(planned.hint("shuffle_hash"), (F.col("h") == F.col("h2")) & (F.col("i") == F.col("i2")))
    part = held.select("key", "h", "piece", "begin", "end", "n_tokens", "cut", F.struct("i", F.expr("substring(t, skip + lo + 1, least(hi, own) - lo)").alias("t")).alias("x"))
    # A piece is put together from the ranges it touches; rows that came repeatedly give each part as often.
    joined = part.groupBy("key", "h", "piece", "begin", "end", "n_tokens", "cut").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    joined = joined.withColumn("one", F.array_distinct("xs")).withColumn("times", F.explode(F.array_repeat(F.lit(1), (F.size("xs") / F.size("one")).cast("int"))))
    return joined.select("key", "piece", "begin", "end", "n_tokens", "cut", F.array_join(F.transform("one", lambda x: x["t"]), "").alias("text"))
