"""Pages that are mainly repeated keywords, links or product tags.

Every line is cut into segments, and every segment is reduced to a shape: its kind, a class of word counts, of capitals, of
separators and of links. Shapes are grouped per page; a page is flagged when few shapes (FEW) that aren't sentences hold more than half
of its characters other than white space. Sentence shapes are those of prose, and of what machines and programmers write (logs,
configurations, code), which is no spam either. A sentence that keeps repeating the same words counts as keywords.

Defined cases: null, empty and blank texts are no case; each row is judged by itself and its whole text, so copies under other
ids come out too; the same doc_id delivered twice comes out once, if any of its texts is a case; a null doc_id names no
page; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.5
#: So many of a page's shapes other than sentences, the largest, must hold the share: spam repeats itself, while a page that is pieced
#: together of many kinds of labels, lists and links is none.
FEW = 6
#: A segment repeats itself when so much of it is word pairs that come at least twice, or one word three times; where nothing
#: comes three times, it takes MOSTLY, since a sentence may well repeat a phrase once.
REPEATED, MOSTLY = 0.3, 0.7
#: Segments without commas or digits, taken together, are shuffled keywords when they have at least LEAST_MIXED words, few of them
#: different, and those in ever new order: prose that repeats itself repeats its order too.
LEAST_MIXED, DIFFERENT, ORDERS = 20, 0.35, 1.8
#: A question of so few words stays with its answer.
SHORT_QUESTION = 6
LEAST_WORDS = 6
#: Every part of these patterns is possessive or can't begin again within what it has passed, so that a line takes time in proportion
#: to its length whatever it holds.
LINK = r"<a\s[^<>]*+>(?:[^<]++|<(?!/?a\b))*+</a>|!?\[[^\[\]\n]*+\]\([^()\s]*+\)|https?://[^\s<>\"|]++|(?<![\w@.-])(?:[\w-]++\.)+[a-z]{2,10}/[^\s<>\"|]*+|(?<!\w)www\.[^\s<>\"|]++"
PAGES = "doc_id bigint, chars bigint, other_chars bigint, other_shapes bigint, few_chars bigint, main_shape string"

_link = re.compile(LINK, re.IGNORECASE)
_word = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_end = re.compile(r"(?<=[.!?…])[\"')\]]*\s+|(?<=[。！？])")
_closed = re.compile(r"[.!?。！？…][\"')\]]*\s*$")
_field = re.compile(r"\s*(?:[|;,/•·、；，\t]|\s[-–—>]+\s|\(\d+\)|\]\s*\[|(?<!\w)#(?=\w)|<br\s*/?>)\s*")
_call = re.compile(r"\w\(|\w\[\w")
_quoted_key = re.compile(r"\"\s*+:")
_indent = re.compile(r"\s{4,}+\S|\t|#\s")
_setting = re.compile(r"\s*+[\w.]++:\s*+$|\s*+[\w.-]++\s*+:\s*+[\w.\[\]-]++\s*+$")
_any_word = re.compile(r"\w")
_spaces = re.compile(r"[^\S\t]{2,}+")
_count = re.compile(r"\(\d+\)")
_inner = re.compile(r"[\d,;:()，；：、]")
_bullet = re.compile(r"^\s*+(?:[-*•☐☑]|\d++[.)]|Step \d++:)\s++")


def _size(n: int) -> str:
    return next(k for k, most in (("0", 0), ("few", 5), ("line", 24), ("long", 10**9)) if n <= most)


SPACES = " \t\r\n\u00a0\u3000"
_letters = re.compile(r"[\W\d_]+")
DIGITS = "0123456789"
#: A line of which digits are this part, and nearly half of letters and digits together, is a machine's.
DIGIT_PART = 1 / 8
SEPARATORS = "|;,/•·、；，\t#[("
#: Words found again must be this part of a segment's words for it to reach REPEATED: two places of a pair cover four words.
AGAIN = REPEATED / 2


def _dense(t: str) -> int:
    """Characters other than white space."""
    return len(t) - sum(map(t.count, " \t\r" if t.isascii() else SPACES))


def repeats(words: list[str]) -> float:
    """Part of the words that lie in pairs of neighbours found at least twice, or are found three times; 0 for less than MOSTLY
    without anything found three times."""
    n = len(words)
    if n < LEAST_WORDS or n - len(set(words)) < AGAIN * n:
        return 0.0
    pairs = Counter(zip(words, words[1:]))
    single = Counter(w for w in words if len(w) > 3 or len(w) > 1 and ord(w[0]) > 0x2E80)
    hit = [single[w] > 2 for w in words]
    often = any(hit)
    for i, p in enumerate(zip(words, words[1:])):
        if pairs[p] > 1 and max(map(len, p)) > 2 - (p[0][0] > "\u2e80"):
            hit[i] = hit[i + 1] = True
            often = often or pairs[p] > 2
    part = sum(hit) / n
    return part if often or part >= MOSTLY else 0.0


def _capitals(t: str) -> str:
    return "upper" if t.isupper() else "title" if t.istitle() else "lower" if t[1:].islower() else "mixed"


def _machine(line: str) -> bool:
    """Whether the line is written by or for a machine, by its signs; patterns run only where their signs are."""
    if "{" in line or "}" in line or "=" in line or not _any_word.search(line):
        return True
    if ("(" in line or "[" in line) and _call.search(line):
        return True
    if (line[0] == "#" or line[0].isspace()) and _indent.match(line):
        return True
    return ":" in line and bool(_setting.match(line) or ('"' in line and _quoted_key.search(line)))


def _sentences(line: str) -> list[str]:
    """Sentences, a short question together with what follows it."""
    parts = _end.split(line)
    if "?" not in line and "？" not in line:
        return parts
    out: list[list[str]] = []
    asks, words = False, 0
    for p in parts:
        if asks and words <= SHORT_QUESTION:
            out[-1].append(p)
        else:
            out.append([p])
            words, asks = 0, False
        if words <= SHORT_QUESTION:
            words += len(_word.findall(p))
        if not p.isspace() and p:
            asks = p.rstrip().endswith(("?", "？"))
    return [" ".join(x) for x in out]


def _shuffled(parts: list[list[str]]) -> bool:
    n = sum(map(len, parts))
    if n < LEAST_MIXED:
        return False
    words = {w for p in parts for w in p}
    return len(words) <= DIFFERENT * n and len({q for p in parts for q in zip(p, p[1:])}) >= ORDERS * len(words)


def segments(text: str) -> list[tuple[str, bool, int]]:
    """(shape, whether it is a sentence, characters) of each segment."""
    out, plain, pool = [], [], []
    for shape, sentence, n, words in _segments(text):
        if words and (not sentence or not _inner.search(words[0])):
            pool.append(words[1])
            if sentence:
                plain.append(len(out))
        out.append((shape, sentence, n))
    if plain and _shuffled(pool):
        for k in plain:
            out[k] = (out[k][0].replace("sentence", "keywords"), False, out[k][2])
    return out


def _segments(text: str) -> Iterator[tuple[str, bool, int, tuple[str, list[str]] | None]]:
    """The same of each segment by itself, with text and words of sentences and keywords."""
    for line in text.splitlines():
        if not line or line.isspace():
            continue
        rest = line
        if ("/" in line or "www." in line or "](" in line) and (links := _link.findall(line)):
            rest = _link.sub(" ", line)
            if len(_word.findall(rest)) <= 6 * len(links):
                yield f"links/{_size(len(links))}/{_capitals(rest)}", False, _dense(line), None
                continue
            yield f"links/{_size(len(links))}/in text", False, sum(map(len, links)), None
        counted = "(" in rest and bool(_count.search(rest))
        if not counted and (_machine(rest) or (d := sum(map(rest.count, DIGITS))) > DIGIT_PART * len(rest) and d > 0.45 * (len(_letters.sub("", rest)) + d)):
            yield "machine", True, _dense(rest), None
            continue
        for part in _sentences(rest[m.end() :] if (m := _bullet.match(rest)) else rest):
            n = _dense(part)
            if not n:
                continue
            w = _word.findall(part.lower())
            closed = bool(_closed.search(part[-8:])) and not part.rstrip().endswith("...")
            k = 1
            if not closed and (sum(map(part.count, SEPARATORS)) > 1 or " - " in part or "<br" in part):
                k = sum(not f.isspace() and f != "" for f in _field.split(_spaces.sub(" ", part).strip(" #[]|")))
                strong = "|" in part or "#" in part or "[" in part or counted or (";" in part and "; " not in part) or " / " in part
                if (k >= 3 and strong or k >= 5) and len(w) <= 5.5 * k:
                    yield f"list/{_size(k)}/{_capitals(part)}", False, n, None
                    continue
            if repeats(w) >= REPEATED:
                yield f"keywords/{_size(len(w))}/{_capitals(part)}", False, n, (part, w)
            elif len(w) <= 5 and not closed:
                yield f"label/{_size(len(w))}/{_capitals(part)}", False, n, None
            else:
                yield f"sentence/{_size(len(w))}/{_size(k)}", True, n, (part, w)


def page(text: str) -> tuple[int, int, int, int, str | None]:
    """Characters, those in shapes that aren't sentences, the number of such shapes, the characters in the FEW largest, the largest."""
    chars, other = 0, Counter()
    for shape, sentence, n in segments(text):
        chars += n
        if not sentence:
            other[shape] += n
    most = sorted(other.items(), key=lambda x: (-x[1], x[0]))
    return chars, other.total(), len(other), sum(n for _, n in most[:FEW]), most[0][0] if most else None


def judged(documents: DataFrame) -> DataFrame:
    """The measures of each row with an id and a text; nothing is shuffled."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(doc, *page(t)) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)) if (t := text.as_py())]
            if rows:
                types = (*[pa.int64()] * 5, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[z.split()[0] for z in PAGES.split(", ")])

    return documents.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, PAGES)


def pages(documents: DataFrame) -> DataFrame:
    """Per page: characters, those of shapes that aren't sentences, how many such shapes, what the FEW largest hold, and the largest of
    them; of several texts of a doc_id the one with the most characters in few shapes."""
    names = [z.split()[0] for z in PAGES.split(", ")]
    rest = F.struct("few_chars", "chars", *[n for n in names if n not in ("doc_id", "few_chars", "chars")])
    return judged(documents).groupBy("doc_id").agg(F.max(rest).alias("p")).select(*[F.col(n if n == "doc_id" else f"p.{n}").alias(n) for n in names])


def flagged(documents: DataFrame) -> DataFrame:
    """The doc_id of each page more than half of which is in few shapes that aren't sentences."""
    return judged(documents).where(F.col("few_chars") > SHARE * F.col("chars")).select("doc_id").distinct()
