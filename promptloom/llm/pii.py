"""Personal data: named patterns, and a linear-chain conditional random field over word shapes that finds what they miss.

The field is trained on a small labelled table: ``planted`` lines that show personal data in forms the patterns do not match, beside dates, numbers and codes
that are none, and lines of the documents with a digit or an at sign, labelled by the patterns. Of the latter it sees at most ``snippets``, and none that
holds more than the patterns explain. Each task scores whole texts in numpy batches: a word's kind (its tuple of shape features) selects a row of
scores, and one Viterbi pass decodes all the batch's words. Words tagged as personal outside the patterns' spans become spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.llm.common import sample_by_hash
from promptloom.llm.crf import TAGS, Model, decode, emissions, features, luhn, train

KINDS = TAGS[1:]
Span = tuple[int, int, int]

# The base patterns and their checks. Runs are possessive where giving back cannot help, so that none takes quadratic time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[Span]:
    """(kind, start, stop) of the patterns' matches that pass their checks, by kind, then start."""
    out: list[Span] = []
    # An address is fixed by its at sign: the longest local part before it that no earlier address holds, and a domain behind it.
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            out.append((0, start, found.end()))
            free = found.end()
        else:
            # The run before a failed sign is not read again for the next one.
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def weak_labels(docs: DataFrame, text: str = "text", snippets: int = 3_000, longest: int = 2_000) -> DataFrame:
    """A small labelled table (text, spans) from distinct lines with a digit or an at sign, at most ``snippets`` of them. A line of more than ``longest`` characters
    is cut at spaces into windows of about that length, of which those with a digit or an at sign count as lines; a word longer than that is cut too."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n", -1)).alias("text"))
    windows = F.regexp_extract_all("text", F.lit(rf"\S[\s\S]{{0,{longest - 2}}}(?!\S)|\S{{1,{longest}}}"), F.lit(0))
    lines = lines.select(F.explode(F.when(F.char_length("text") <= longest, F.array("text")).otherwise(windows)).alias("text"))
    picked = sample_by_hash(lines.filter(F.col("text").rlike("[0-9@]")).distinct(), snippets, "text")

    @F.udf("array<struct<kind:int,start:int,stop:int>>")
    def spans(line):
        return base_spans(line)

    return picked.select("text", spans("text").alias("spans"))


# Forms of personal data that the patterns miss, and what looks like it and is none: 9 stands for a digit, w for a word, C for a number's digits that pass the Luhn check.
FORMS = {
    "email": ("w@w", "w.w@w", "w99@w", "w@wé.w", "w@wü.w.w"),
    "card": ("CCCC.CCCC.CCCC.CCCC", "CCCC/CCCC/CCCC/CCCC", "CCCC_CCCC_CCCC_CCCC"),
    "phone": ("(999) 999-9999", "(9999) 999999", "999/999-9999", "9999/9999999", "999-999-9999", "999.999.9999"),
    "": ("9999-99-99", "99.99.9999", "99/99/9999", "99:99", "9,999.99", "9999", "99", "999999", "99999999", "9999999999", "9999999999999999", "9.99.9", "9999-9999",
         "999-9-99-999999-9", "9w99w9w9", "99w9999w99", "w-99", "#9999", "(9999)", "(99)", "99%", "99999-9999", "@w", "9999-99-99w99:99:99"),
}


def _filled(form: str, random: np.random.Generator) -> str:
    digits = [int(d) for d in random.integers(0, 10, form.count("C"))]
    if digits:
        # The last digit that makes the sum pass.
        digits[-1] = next(d for d in range(10) if luhn("".join(map(str, [*digits[:-1], d]))))
    card = iter(digits)
    word = lambda: "".join(random.choice(list("abcdeghilmnorstu"), random.integers(2, 9)))
    return "".join(str(random.integers(0, 10)) if c == "9" else str(next(card)) if c == "C" else word() if c == "w" else c for c in form)


def planted_rows(rows: int = 1_500, seed: int = 1) -> list[tuple[str, list[Span]]]:
    """Lines of invented words with up to three forms each, and the places of those that are personal data; made by rule, equal for equal arguments."""
    random = np.random.default_rng(seed)
    forms = [(KINDS.index(kind) if kind else None, form) for kind, fs in FORMS.items() for form in fs]
    out = []
    for _ in range(rows):
        text, spans = "", []
        for _ in range(random.integers(1, 4)):
            text += _filled("w " * random.integers(0, 5), random)
            kind, form = forms[random.integers(len(forms))]
            body = _filled(form, random)
            if kind is not None:
                spans.append((kind, len(text), len(text) + len(body)))
            text += body + str(random.choice(["", "", ".", ","])) + " w "[: random.integers(1, 3)].replace("w", "end")
            text += "" if text.endswith(" ") else " "
        out.append((text.strip(), spans))
    return out


def labelled_table(docs: DataFrame, text: str = "text", snippets: int = 3_000) -> DataFrame:
    """``weak_labels`` of the documents (weak) and the ``planted_rows`` (not weak): text, spans, weak."""
    schema = "text string, spans array<struct<kind:int,start:int,stop:int>>, weak boolean"
    planted = docs.sparkSession.createDataFrame([(t, s, False) for t, s in planted_rows()], schema)
    return weak_labels(docs, text, snippets).withColumn("weak", F.lit(True)).unionByName(planted)


def _unexplained(word: str) -> bool:
    """What a pattern may have missed: an at sign, five digits or more, a number in parentheses."""
    return "@" in word or sum("0" <= c <= "9" for c in word) >= 5 or word[0] == "(" and bool(_DIGIT.match(word[1:2]))


def fit(labelled: DataFrame, around: int = 6) -> Model | None:
    """Train on rows of (text, spans): the words within ``around`` of one that is labelled or holds a digit or at sign. None without such words.

    Rows whose column ``weak`` is true, if there is one, are left out where an unlabelled word may yet be personal data.
    """
    sentences = []
    for row in labelled.select("text", "spans", *[c for c in ("weak",) if c in labelled.columns]).collect():
        words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"\S+", row["text"] or "")]
        tags = [0] * len(words)
        for kind, start, stop in row["spans"] or []:
            for k, (_, a, b) in enumerate(words):
                if a < stop and start < b:
                    tags[k] = kind + 1
        if "weak" in row and row["weak"] and any(not t and _unexplained(w) for t, (w, *_) in zip(tags, words)):
            continue
        near = [k for k, (w, *_) in enumerate(words) if tags[k] or "@" in w or _DIGIT.search(w)]
        chosen = sorted({j for k in near for j in range(max(0, k - around), min(len(words), k + around + 1))})
        cut: list[int] = []
        for j in [*chosen, None]:
            if cut and (j is None or j != cut[-1] + 1 or len(cut) >= 30):
                sentences.append(([words[i][0] for i in cut], [tags[i] for i in cut]))
                cut = []
            if j is not None:
                cut.append(j)
    return train(sentences) if sentences else None


class Kinds(dict):
    """Numbers of words' kinds, with the score rows of each kind; words are remembered up to a bounded number, kinds too."""

    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most, self.known, self.table = model, most, {}, []

    def __missing__(self, word: str) -> int:
        kind = features(word)
        number = self.known.get(kind)
        if number is None:
            number = self.known[kind] = len(self.table)
            self.table.append(self.model.rows(word))
        self[word] = number
        return number

    def tidy(self) -> None:
        """Between batches only, since numbers in use must stay."""
        if len(self) > self.most or len(self.table) > self.most // 4:
            self.clear()
            self.known.clear()
            self.table.clear()


def model_spans(model: Model, kinds: Kinds, texts: list[str]) -> list[list[Span]]:
    """Spans of the words that the field tags as personal, with the punctuation around them stripped; neighbours of a number kind are joined."""
    kinds.tidy()
    words = [t.split() for t in texts]
    numbers = np.fromiter((kinds[w] for ws in words for w in ws), np.int64, sum(map(len, words)))
    ends = np.cumsum([len(ws) for ws in words])
    out: list[list[Span]] = [[] for _ in texts]
    if not len(numbers):
        return out
    tags = decode(model, emissions(model, np.stack(kinds.table), numbers, ends), ends)
    hits = np.flatnonzero(tags)
    for k in np.unique(np.searchsorted(ends, hits, "right")):
        first = ends[k] - len(words[k])
        found: list[Span] = []
        for i, m in enumerate(re.finditer(r"\S+", texts[k])):
            tag = int(tags[first + i])
            if not tag:
                continue
            body = m.group().strip(".,;:!?\"'<>[]{}")
            if not (_DIGIT.search(body) or "@" in body):
                continue
            start = m.start() + m.group().index(body)
            span = (tag - 1, start, start + len(body))
            if found and found[-1][0] == span[0] and span[0] >= 2 and not texts[k][found[-1][2] : start].strip():
                found[-1] = (span[0], found[-1][1], span[2])
            else:
                found.append(span)
        out[k] = found
    return out


def _plausible(text: str, span: Span) -> bool:
    """What a tagged span must hold at the least: an address its sign, numbers enough digits, a card's the checksum too."""
    kind, start, stop = span
    body = text[start:stop]
    digits = "".join(c for c in body if "0" <= c <= "9")
    n = len(digits)
    return (kind == 0 and "@" in body[1:-1] or kind == 1 and body.count(".") == 3 and n >= 4 or kind == 2 and 16 <= n <= 19 and luhn(digits)
            or kind == 3 and 8 <= n <= 15)


def find(model: Model | None, kinds: Kinds | None, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind, then start. The field adds spans that overlap no base span."""
    extra = model_spans(model, kinds, texts) if model is not None else [[]] * len(texts)
    for text, more in zip(texts, extra):
        base = base_spans(text)
        added = [s for s in more if _plausible(text, s) and not any(a < s[2] and s[1] < b for _, a, b in base)]
        yield base, sorted(base + added)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def _arrow(rows: list[list[Span]]) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    return pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in spans] for spans in rows], kind)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", model: Model | None = None) -> DataFrame:
    """The columns of ``keep``, then ``base`` and ``found``: arrays of (kind number, start, stop), by kind, then start.

    Without a ``model`` one is trained on the ``labelled_table`` of the documents; without documents that is the planted lines alone. Texts are
    read whole; null and empty ones have no spans. Rows are scanned one by one, so repeated rows give equal results. No documents give no rows;
    columns not in ``keep`` are not read.
    """
    model = fit(labelled_table(docs, text)) if model is None else model
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("base", SPANS), T.StructField("found", SPANS)])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(model) if model is not None else None
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                found = list(find(model, kinds, [t or "" for t in batch.column(width).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], _arrow([b for b, _ in found]), _arrow([a for _, a in found])], schema.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one, named by the first."""
    out, at, covered = [], 0, 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], s[0], s[2])):
        if start >= covered:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = covered = stop
        elif stop > covered:
            at = covered = stop
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", model: Model | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text``, and ``n_chars`` counted anew where something was. All other columns stay as they are."""
    model = fit(labelled_table(docs, text)) if model is None else model
    schema, at = docs.schema, docs.columns.index(text)
    count = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(model) if model is not None else None
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                columns, texts = list(batch.columns), batch.column(at).to_pylist()
                spans = [a for _, a in find(model, kinds, [t or "" for t in texts])]
                if any(spans):
                    new = [redacted(t, s) if s else t for t, s in zip(texts, spans)]
                    columns[at] = pa.array(new, columns[at].type)
                    if count is not None:
                        old = columns[count].to_pylist()
                        columns[count] = pa.array([len(t) if s else c for t, s, c in zip(new, spans, old)], columns[count].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
