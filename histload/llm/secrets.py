"""Secrets in texts: fixed patterns, and strings that compression finds new.

The patterns (base spans) are an assignment to a sensitive name, an access key id and a long hex
number. Beyond them, each long string after a sensitive word is a candidate, be it a run of its own or
what follows the word and a separator in the word's own run. '=' separates name and value, and belongs
to a string only as padding at its end. Its novelty is its compressed size, by zstandard primed with its
surroundings and a dictionary of identifiers that code is full of: words, paths and names cost little,
random keys nearly their entropy. Candidates, whatever their length, are reported if they are outside
the base spans and as new as random characters of their alphabet are at least: NOVELTY bytes a
character, or, since long strings come close to it, the alphabet's entropy and FIXED bytes. Strings
whose neighbouring letters and digits are mostly PAIRS of letters in common languages are words.

Every text is searched whole; the surroundings are CONTEXT characters on each side, without up to COPIES copies
of the string itself, so a secret that is written twice is found twice. Rows are
searched one by one, without a shuffle, so repeated rows have equal results.

Defined results: a NULL or empty text has no spans. Positions are code points, the end exclusive. An
assignment's span is the whole match. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from histload.llm.tables import small_arrow_batches

KINDS = ("assign", "access", "hex", "novel")
CONTEXT = 200
NOVELTY, FIXED = 0.8, 6
SHORTEST = 16  # characters of a candidate
WORDLIKE = 0.75  # share of PAIRS among the neighbours in words; random letters have 0.35
RAISED = 1.3  # times the novelty that strings of words need
COPIES = 2  # of a string in its surroundings that do not make it known
REACH = 60  # characters between a sensitive word's begin and the candidate's

# The patterns of base spans.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_SENSITIVE = re.compile(
    r"(?:passw|secret|token|api_?key|credential|private|auth|bearer|access|signature|pwd)",
    re.IGNORECASE | re.ASCII,
)
_RUN = re.compile(r"[A-Za-z0-9+/_.~-]+(?:=+(?![A-Za-z0-9+/_.=~-]))?")
_BEGIN = re.compile(r"[A-Za-z0-9+/_.~-]")
_NAME_END = re.compile(r"[A-Za-z0-9]*[+/_.~-]+")

_IDENTIFIERS = (
    "public static void private class return import from const function self config settings "
    "username password secret token api_key apikey access_key auth bearer authorization header "
    "credential signature client_id client_secret database connection string localhost example "
    "http://www. https://api. .com/ .org/ .json .yaml .html index main test value default version "
    "application/json content-type user-agent session cookie environment production development "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
)
# Letters, each with those that often follow it in words of English, German, French or Spanish.
_FOLLOWERS = (
    "abcdgiklmnprstuvy baeiorlsu cehaikloprtu daeiorsu eabcdfgilmnprstuvx faeioru gaehilnorsu haeiortu "
    "iabcdefglmnoprstvz jaeou keins ladefilostuy mabeimopsu nacdefgiklnostuv obcdfgilmnoprstuvw "
    "paehiloprstu qu racdeghiklmnorstuvy sacehiklmnopstuy taehilorstuyz uabcdegilmnprst vaeio waehior "
    "xaceipt yeops zaeiou"
)
PAIRS = frozenset(row[0] + letter for row in _FOLLOWERS.split() for letter in row[1:])
_ALNUM = re.compile(r"[a-z0-9]+")
# The parts of an alphabet, each with its number of characters.
_PARTS = [(re.compile(part), size) for part, size in (("[0-9]", 10), ("[a-z]", 26), ("[A-Z]", 26), ("[+/_.~-]", 6))]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    # A maximal run of hex digits is what the pattern without a length matches.
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


class Novelty:
    """Bytes of a string compressed with its surroundings known. They are a dictionary and not part of
    what is compressed: else random strings nearby would share their code table with it."""

    def __call__(self, before: str, after: str, candidate: str) -> float:
        import zstandard

        known = (_IDENTIFIERS * 2 + before + after).encode("utf-8", "replace")
        primer = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=9, dict_data=primer, write_checksum=False)
        return len(compressor.compress(candidate.encode())) - len(compressor.compress(b""))


def candidates(text: str, reach: int = REACH) -> Iterator[tuple[int, int]]:
    """Spans of whole runs that begin at most ``reach`` characters after a sensitive word begins, and of
    the rests of runs with a sensitive word in them. Of a run only words within ``reach`` of its first one
    count, so that its length is met a bounded number of times."""
    first, stop, done = 0, 0, 0  # the first word in a run and the run's end; end of the runs given
    for word in _SENSITIVE.finditer(text):
        if word.end() > stop:
            own = _RUN.match(text, word.start())
            first, stop = word.start(), own.end()
        if word.start() <= first + reach and (name := _NAME_END.match(text, word.end(), stop)):
            yield name.end(), stop
        at, limit = max(stop, done), word.start() + reach + 1
        while found := _BEGIN.search(text, at, limit):
            at = done = _RUN.match(text, found.start()).end()
            yield found.start(), at


def is_words(string: str, share: float = WORDLIKE) -> bool:
    """Whether letters and digits follow each other as in words."""
    runs = _ALNUM.findall(string.lower())
    pairs = [a + b for run in runs for a, b in zip(run, run[1:])]
    return sum(pair in PAIRS for pair in pairs) >= share * len(pairs)


def needed(string: str) -> float:
    """The novelty from which a string is reported."""
    own = len(set(string))
    # A string with 4 times as many characters shows its alphabet.
    shown = 4 * own <= len(string)
    size = max(own, 2) if shown else sum(count for part, count in _PARTS if part.search(string))
    return min(NOVELTY * len(string), log2(size) / 8 * len(string) + FIXED)


@dataclass(frozen=True)
class Search:
    """How candidates are found and judged; see the constants of these names."""

    shortest: int = SHORTEST
    reach: int = REACH
    context: int = CONTEXT
    wordlike: float = WORDLIKE
    raised: float = RAISED


def surroundings(text: str, begin: int, end: int, context: int = CONTEXT) -> tuple[str, str]:
    """The characters before and after a string, without up to COPIES copies of it: a secret written again does
    not make itself known. A string with more copies is a name that the text uses."""
    string, size = text[begin:end], context + COPIES * (end - begin)
    before, after = text[max(0, begin - size) : begin], text[end : end + size]
    if before.count(string) + after.count(string) <= COPIES:
        before, after = before.replace(string, " "), after.replace(string, " ")
    return before[len(before) - min(context, len(before)) :], after[:context]


def novel_spans(
    text: str, taken: list[tuple[str, int, int]], novelty: Novelty, search: Search = Search()
) -> list[tuple[str, int, int]]:
    """Spans of candidates near a sensitive word, as new as ``needed``, that overlap none ``taken`` (by
    their begin)."""
    spans, place, covered = [], 0, 0
    for begin, end in candidates(text, search.reach):
        # Candidates come in the order of their ends, so each span is passed once.
        while place < len(taken) and taken[place][1] < end:
            covered = max(covered, taken[place][2])
            place += 1
        if end - begin < search.shortest or begin < covered:
            continue
        string = text[begin:end]
        bar = needed(string) * (search.raised if is_words(string, search.wordlike) else 1)
        if novelty(*surroundings(text, begin, end, search.context), string) >= bar:
            spans.append(("novel", begin, end))
            covered = end
    return spans


class _Searcher:
    def __init__(self, search: Search):
        self.search = search

    def __call__(self, batches):
        novelty = Novelty()
        fields = [("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]
        kind = pa.list_(pa.struct(fields))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                spans = base + novel_spans(text, base, novelty, self.search) if text else []
                spans.sort(key=lambda span: (span[1], KINDS.index(span[0])))
                rows.append([dict(zip(("kind", "begin", "end"), span)) for span in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"]
            )


def secret_spans(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """(doc_id, spans): for every row of ``docs`` (doc_id, text) its spans as (kind, begin, end), by
    begin, then by kind in the order of KINDS."""
    small_arrow_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {id_type}, spans array<struct<kind: string, begin: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(_Searcher(search), ddl)
