"""Op 9. Secret scans: fixed patterns, and strings in a sensitive context that a primed compressor can't predict.

Patterns (leftmost, not overlapping within a kind): ``assign`` an assignment to a sensitive name, ``access`` an access
key, ``hex`` a long run of hexadecimal digits. Novelty (``novel``): a candidate is a run of key-like characters that
begins within REACH bytes after a sensitive word or ends within REACH before one. It is compressed by zstandard after the
code that surrounds it, with a dictionary of identifiers: common ones, and the names that the documents themselves use
(``learn_identifiers``, counted over all of them). The bytes that the string adds to its surroundings alone, for each of
its characters, measure how new it is; names and prose cost little, keys cost what random characters cost. Other
occurrences of the string are cut out of the surroundings, so that a key that is written twice is as new as one that is
written once. A string without small letters is measured in small ones too and the lesser counts, since names in capitals
are no newer than the same names in small letters. The limit is NOVEL, or NOVEL_LETTERS for a run of letters of one case:
random ones carry less each, 4.7 bits, than those of larger alphabets. No alphabet is left out. Other keys around a key,
as in a list of keys, teach the compressor how often each letter comes, and its letters cost little then though their order
is as new as ever. So a string below the limit that has other runs of key-like characters around it counts as well if it
reaches the limit without those runs around it, and NOVEL_ORDER with them but letters stored as they are. Spans are code
points, end exclusive. One pass over the texts; only counts of names are shuffled.

Rows: null text counts as empty and has no spans. A very long text is searched whole. Null doc_id and repeated rows are
rows like others. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import slices

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")  # a maximal run begins where the first sixteen of it do
_NAMES = (b"passw", b"secret", b"token", b"api")
_SENSITIVE = re.compile(rb"passw|passphrase|secret|token|api.?key|credential|private.?key|access.?key|bearer|authorization", re.IGNORECASE)
_WORDS = (b"passw", b"passphrase", b"secret", b"token", b"key", b"credential", b"bearer", b"authorization")
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")

_PARTS, _GAP = re.compile(rb"[^A-Za-z0-9+/_-]+"), b"\0"  # a string stands elsewhere without the = or the name before it

REACH = 80  # bytes after a sensitive word in which a candidate may begin, or before it in which one may end
AROUND = 512  # bytes before and after a candidate that it is measured against
NOVEL, NOVEL_LETTERS = 0.8, 0.7  # compressed bytes for each character, at least; of letters of one case alone
NOVEL_ORDER = 0.8  # the same where only repetitions are compressed
_LEAD = bytes(64)  # repeats itself, so that no block is too poor in repetitions to be compressed

#: A name as code writes it: words joined by underscores, words in camel case, or what stands before an equals sign or a colon.
_NAME = r"\b(?:[A-Za-z]{2,24}(?:_[A-Za-z]{2,24})+|[A-Za-z][a-z]+(?:[A-Z][a-z]+)+|[A-Za-z_]{3,32}(?=\x20?[=:]))"

# Common parts of identifiers and of code.
PARTS = """
access account active add admin all api app append apply args array async attribute auth authorization await backend base batch begin body bool
bucket buffer build byte cache call callback cancel cert char check child class clean client close cloud cluster code column command commit
common compute config connect connection const container content context control controller copy core count create credential current cursor
data database date debug default define delete deploy description dest detail device dict directory disable display document domain driver
dump dynamic element email enable encode end endpoint engine entry env environment error event example exception exec execute expire export
extra factory false field file filter final find first flag float folder format free from function future gateway generate get global graph
group handle handler hash head header health help host html http https id image import index info init input insert instance int interface
internal is item iterator job join json key label lambda last latest layer length level library limit line link list listener load local
location lock log logger login loop main make manager map mapping master match matrix max member memory merge message metadata method metric
min mock mode model module monitor name namespace network new next node none notification null num number object offset on open operation
option order origin output owner package page param parent parse parser partition pass passphrase password path pattern payload pending
permission pipeline placeholder policy pool port position prefix private process processor profile project property protocol provider proxy
public query queue random range rate raw read reader record ref refresh region register registry release remote remove render replace report
repository request require reset resource response rest result return role root route row rule run runtime sample scan schedule scheme schema
scope script search secret section secure select self send sequence server service session set settings shared signature size socket source
spec stack stage start state static status step storage store stream string struct style submit sum super sync system table tag target task
team temp template test text thread time timeout timestamp title token topic total trace track transaction transform tree trigger true type
update upload url user username util uuid valid validate validator value variable vector verify version view visible void volume wait web
worker wrapper write writer xml yaml zone
"""

#: The dictionary's part that is the same for all tables: the parts, capitalised too, and names that are often seen near secrets.
IDENTIFIERS = " ".join(
    [
        *PARTS.split(), *map(str.capitalize, PARTS.split()),
        *(
            a + b + c for a in ("get", "set", "new", "load", "read", "user", "client", "default") for b in ("_", "") for c in (
                "password", "secret", "token", "api_key", "credential", "Password", "Secret", "Token", "ApiKey",
            )
        ),
    ]
).encode()


class Scanner:
    def __init__(self, identifiers: bytes = IDENTIFIERS, novel: float = NOVEL, letters: float = NOVEL_LETTERS, level: int = 9) -> None:
        import zstandard as z

        d = z.ZstdCompressionDict(identifiers, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        self.compress = z.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False).compress
        self.novel, self.letters = novel, letters
        # zstandard leaves letters as they are in its fast strategy with a target length
        fast = z.ZstdCompressionParameters(window_log=17, hash_log=17, min_match=4, target_length=1, strategy=z.STRATEGY_FAST, write_content_size=False, write_checksum=False)
        d = z.ZstdCompressionDict(identifiers, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=fast)
        self.repetitions = z.ZstdCompressor(compression_params=fast, dict_data=d).compress

    def _around(self, text: bytes, start: int, end: int, runs: bool = True) -> bytes:
        """The surroundings of text[start:end] without its other occurrences, or without any run of key-like characters."""
        s = text[start:end]
        more = AROUND + len(s)  # an occurrence that the window cuts is found whole
        before, after = text[max(0, start - more) : start], text[end : end + more]
        for part in sorted({s, *(x for x in _PARTS.split(s) if len(x) >= 16)}, key=len, reverse=True):
            before, after = (x.replace(part, _GAP * len(part)) for x in (before, after))
        if not runs:
            before, after = (_CANDIDATE.sub(lambda m: _GAP * len(m[0]), x) for x in (before, after))
        return (before[-AROUND:] + after[:AROUND]).replace(_GAP, b"")

    @staticmethod
    def _added(compress: Callable[[bytes], bytes], around: bytes, s: bytes) -> float:
        forms = [s] if s.lower() == s or s.upper() != s else [s, s.lower()]
        return (min(len(compress(around + x)) for x in forms) - len(compress(around))) / max(1, len(s))

    def novelty(self, text: bytes, start: int, end: int) -> float:
        """Bytes that text[start:end] adds to its surroundings when compressed, for each of its characters; below the limit, if it
        repeats little of them, those that it adds without the other runs around it, if they are more."""
        s, around = text[start:end], self._around(text, start, end)
        found = self._added(self.compress, around, s)
        if found >= self.limit(s) or (alone := self._around(text, start, end, runs=False)) == around:
            return found
        return max(found, self._added(self.compress, alone, s)) if self._added(self.repetitions, _LEAD + around, s) >= NOVEL_ORDER else found

    def limit(self, s: bytes) -> float:
        return self.letters if s.isalpha() and s in (s.lower(), s.upper()) else self.novel

    def scan(self, text: bytes) -> list[tuple[int, int, int, float | None]]:
        """(start, end, kind, novelty) of all spans, in bytes, by start and then kind; those of the patterns aren't measured."""
        found, low = [], text.lower()
        if any(k in low for k in _NAMES):
            found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
        if b"AKIA" in text:
            found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
        found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
        spans: list[tuple[int, int, int, float | None]] = [(*f, None) for f in found]
        if any(k in low for k in _WORDS):
            spans += self._novel(text, [(a, b) for a, b, _ in found])
        return sorted(spans, key=lambda x: (x[0], x[2]))

    def _novel(self, text: bytes, found: list[tuple[int, int]]) -> list[tuple[int, int, int, float]]:
        """Candidates that overlap nothing found by the patterns. A sensitive word splits the run that it stands in."""
        words = [m.span() for m in _SENSITIVE.finditer(text)]
        begins, ends = [a for a, _ in words], [b for _, b in words]
        taken = sorted(found)
        reached = list(accumulate((b for _, b in taken), max))  # how far those up to one reach
        spans = []
        for m in _CANDIDATE.finditer(_SENSITIVE.sub(lambda m: _GAP * len(m[0]), text)):
            start, end = m.span()
            last, next_ = bisect_right(ends, start) - 1, bisect_left(begins, end)
            after = last >= 0 and start - ends[last] < REACH
            before = any(0 < a - end < REACH for a in begins[next_ : next_ + 2])  # what touches the word is part of one name with it
            if not (after or before):
                continue
            earlier = bisect_left(taken, (end, 0))  # those that begin before the end
            if not (earlier and reached[earlier - 1] > start) and (x := self.novelty(text, start, end)) >= self.limit(m[0]):
                spans.append((start, end, 3, x))
        return spans


def learn_identifiers(docs: DataFrame, most: int = 4096, least_docs: int = 3) -> bytes:
    """Dictionary content: IDENTIFIERS and the ``most`` names without digits that the most documents of ``docs`` hold, at
    least ``least_docs`` of them, the commonest last. All texts are counted; at most ``most`` names come to the driver."""
    names = docs.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_NAME), F.lit(0)))).alias("name"))
    counts = names.groupBy("name").count().filter(F.col("count") >= least_docs)
    found = [r.name for r in counts.orderBy(F.desc("count"), "name").limit(most).collect()]
    return IDENTIFIERS + b"".join(b" " + n.encode() for n in reversed(found))


_SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,novelty:double>>"


def find_secrets(
    docs: DataFrame, identifiers: bytes = IDENTIFIERS, novel: float = NOVEL, letters: float = NOVEL_LETTERS,
) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, novelty of those that it found), by start and then kind, of every
    row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(identifiers, novel, letters)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))
        for batch, texts in slices(batches):
            rows = []
            for t in texts:
                spans, at, seen = [], 0, 0
                for a, b, k, x in scanner.scan(t):
                    seen, at = seen + len(t[at:a].decode("utf-8", "replace")), a
                    spans.append({"kind": KINDS[k], "start": seen, "end": seen + b - a, "novelty": x})  # spans are ASCII
                rows.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, _SPANS)
