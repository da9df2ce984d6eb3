"""One form for texts that look the same.

Characters that show nothing are deleted and compatibility forms are folded. What remains ambiguous are
letters that several scripts draw alike: every token (run of letters and marks) spans a lattice with all the
letters it could be, and Viterbi's search takes the path that character bigrams of one script explain best.
The lattice and the script of the tokens before depend on how the text looks and on nothing else, so texts
that look the same get the same form, and texts that look different cannot: a path keeps the look of every letter.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.session import cut, spread

# Letters drawn alike, one look per word; the scripts are Latin, Greek, Cyrillic, Armenian, Cherokee.
LOOKS = """
aаα cсϲᴄ eе gց hһհ iі jјϳ nո oοоօ pрρ qԛ sѕ uսυ vνѵ wԝ xх yу dԁ lӏ κк æӕ əә
AΑАᎪ BΒВᏴ CСϹᏟ DᎠ EΕЕᎬ GԌᏀ HΗНᎻ IΙІӀ JЈͿᎫ KΚКᏦ LᏞ MΜМᎷ NΝ OΟОՕ PΡРᏢ QԚ RᏒᎡ SЅՏᏚ TΤТᎢ UՍ VѴᏙ WԜᎳ XΧХ YΥҮУᎩ ZΖᏃ ÆӔ ƏӘ
ΓГ ΠП ΦФ φф
""".split()
# Marks drawn alike that normalization leaves apart, with the mark that stands for them.
MARKS = {"‐": "-", "‑": "-", "﹣": "-", "։": ":", "׃": ":", "∶": ":", "꞉": ":", "⁄": "/", "∕": "/", "ǃ": "!", "‚": ",", "ǀ": "|", "⋅": "·", "‧": "·"}
# Scripts by the first word of a letter's Unicode name.
SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "CHEROKEE")
#: tokens remembered by a task; beyond that it forgets all and goes on
REMEMBERED = 400_000
SMOOTHING, CHANGE_OF_SCRIPT, OTHER_CONTEXT = 0.1, -12.0, -6.0

_LOOK_OF = {ord(c): look[0] for look in LOOKS for c in look}
_READINGS = {look[0]: look for look in LOOKS}
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ҃-҇])*")
# Default-ignorable code points, controls other than tab and line ends, and surrogates.
_IGNORED = re.compile(
    "[\u0000-\u0008\u000b\u000c\u000e-\u001f\u007f-\u0084\u0086-\u009f­͏؜ᅟᅠ឴឵᠋-᠏​‌‎‏"
    "‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￻\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)
_JOINER = "‍"
_LINE_END = re.compile("\r\n|\r|\u0085| | ")
_ASCII_CONTROLS = re.compile("[\x00-\x08\x0b-\x1f\x7f]")
_MARKS = {ord(k): v for k, v in MARKS.items()} | {0x1680: " "}  # the only space that decomposition leaves


def _joins_pictures(s: str, at: int) -> bool:
    return 0 < at < len(s) - 1 and all(unicodedata.category(c) in ("So", "Sk") for c in (s[at - 1], s[at + 1]))


def strip_and_fold(text: str) -> str:
    """Decomposed compatibility form without characters that show nothing; white space is kept one for one.

    A zero-width joiner stays only between pictographs, where it is seen.
    """
    if text.isascii() and not _ASCII_CONTROLS.search(text):
        return text
    s = _IGNORED.sub("", text)
    if _JOINER in s:
        s = "".join(c for i, c in enumerate(s) if c != _JOINER or _joins_pictures(s, i))
    s = _LINE_END.sub("\n", s)
    return unicodedata.normalize("NFKD", s).translate(_MARKS)


def script_of(c: str) -> str:
    name = unicodedata.name(c, "").split(" ")[0]
    return name if name in SCRIPTS else ""


class Reader:
    """Reads tokens: bigram scores and Viterbi's search. ``bigrams`` has (previous, character) -> count; previous is '' at a start."""

    def __init__(self, bigrams: dict[tuple[str, str], int]) -> None:
        self.pair, self.first = bigrams, Counter()
        for (a, _), n in bigrams.items():
            self.first[a] += n
        self.alphabet = len({b for _, b in bigrams}) + 1
        self.scripts: dict[str, str] = {}
        self.own: dict[str, str] = {}
        self.known: dict[tuple[str, str], str] = {}

    def _script(self, c: str) -> str:
        if c not in self.scripts:
            self.scripts[c] = script_of(c)
        return self.scripts[c]

    def _score(self, a: str, b: str) -> float:
        change = CHANGE_OF_SCRIPT if a and self._script(a) != self._script(b) else 0.0
        return change + log((self.pair.get((a, b), 0) + SMOOTHING) / (self.first.get(a, 0) + SMOOTHING * self.alphabet))

    def own_script(self, look: str) -> str:
        """The script of the first letter that is drawn in one script only; '' if there is none."""
        if look not in self.own:
            self.own[look] = next((s for c in look if c not in _READINGS and (s := self._script(c))), "")
        return self.own[look]

    def read(self, look: str, context: str) -> str:
        """The best reading of a token's look in a context of a script; ties go to the letter listed first."""
        if (look, context) in self.known:
            return self.known[look, context]
        best: dict[str, tuple[float, int]] = {"": (0.0, -1)}
        trail: list[list[tuple[str, int]]] = []
        for c in look:
            before, now, steps = list(best.items()), {}, []
            if unicodedata.combining(c):  # marks belong to the letter before
                trail.append([(c, i) for i in range(len(before))])
                continue
            for r in _READINGS.get(c, c):
                top = max(range(len(before)), key=lambda i: before[i][1][0] + self._score(before[i][0], r))
                odd = OTHER_CONTEXT if not trail and context and self._script(r) != context else 0.0
                now[r] = (before[top][1][0] + self._score(before[top][0], r) + odd, top)
                steps.append((r, top))
            best = now
            trail.append(steps)
        ends = list(best.values())
        at = max(range(len(ends)), key=lambda i: ends[i][0])
        out = []
        for steps in reversed(trail):
            letter, before_at = steps[at]
            out.append(letter)
            at = before_at
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.own.clear()
        form = self.known[look, context] = "".join(reversed(out))
        return form

    def canonical(self, text: str) -> str:
        """The text with every token read in the script of the last token before it that has one of its own, at first of the first such token."""
        looks = strip_and_fold(text).translate(_LOOK_OF)
        context = next((s for m in _TOKEN.finditer(looks) if (s := self.own_script(m[0]))), "")

        def form(m: re.Match) -> str:
            nonlocal context
            context = self.own_script(m[0]) or context
            return self.read(m[0], context)

        return unicodedata.normalize("NFC", _TOKEN.sub(form, looks))


def bigram_counts(docs: DataFrame, text: Column) -> DataFrame:
    """a, b, n: counts of neighbouring letters over the tokens of all texts whose letters are of one script."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scripts: dict[str, str] = {}
        counts: Counter = Counter()
        for f in frames:
            tokens: Counter = Counter()
            for t in f["text"]:
                if t:
                    tokens.update(_TOKEN.findall(strip_and_fold(t)))
            for w, n in tokens.items():
                letters = [c for c in w if not unicodedata.combining(c)]
                for c in letters:
                    if c not in scripts:
                        scripts[c] = script_of(c)
                kinds = {scripts[c] for c in letters}
                if len(kinds) == 1 and "" not in kinds:
                    for a, b in zip(["", *letters], letters):
                        counts[a, b] += n
        yield pd.DataFrame([(a, b, n) for (a, b), n in counts.items()], columns=["a", "b", "n"])

    per_task = spread(docs.select(text.alias("text"))).mapInPandas(run, "a string, b string, n bigint")
    return per_task.groupBy("a", "b").agg(F.sum("n").alias("n"))


def fit_reader(docs: DataFrame, text: Column) -> Reader:
    """A reader with the bigrams of all texts. Their number is bounded by the letters of five scripts, not by the corpus; they come as Arrow columns."""
    rows = bigram_counts(docs, text).toPandas().sort_values(["a", "b"])
    return Reader(dict(zip(zip(rows["a"], rows["b"]), rows["n"].tolist())))


def canonical_texts(docs: DataFrame, doc_id: Column, text: Column, reader: Reader) -> DataFrame:
    """doc_id, text, canonical: one row per row of docs. A null text stays null, an empty one empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(canonical=[reader.canonical(t) if t is not None else None for t in f["text"]])

    rows = spread(docs.select(doc_id.alias("doc_id"), text.alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, text string, canonical string")


def text_classes(canonical: DataFrame) -> DataFrame:
    """doc_id, g, h: digests of the canonical form and of the text; texts that show nothing have no row."""
    seen = F.length(F.regexp_replace("canonical", r"\s", "")) > 0
    return canonical.where(seen).select("doc_id", F.unhex(F.sha2("canonical", 256)).alias("g"), F.unhex(F.sha2("text", 256)).alias("h"))


def alike_members(classes: DataFrame) -> DataFrame:
    """doc_id, form, text_no, n_texts, n_docs: of every document whose form occurs in more than one text, the form's digest, which of the form's texts it has, and how many there are.

    One row per document, whatever the number of copies; the pairs that look alike are those of one form and two text_no.
    """
    w = Window.partitionBy("g")
    texts = classes.groupBy("g", "h").agg(F.count(F.lit(1)).alias("n"))  # one row per distinct text, combined before the shuffle
    several = texts.withColumns({"n_texts": F.count(F.lit(1)).over(w), "n_docs": F.sum("n").over(w), "text_no": F.row_number().over(w.orderBy("h"))}).where("n_texts > 1").drop("n")
    return classes.join(several, ["g", "h"]).select("doc_id", F.lower(F.hex("g")).alias("form"), "text_no", "n_texts", "n_docs")


def alike_pairs(classes: DataFrame) -> DataFrame:
    """id_1 < id_2 of documents with one canonical form and different texts.

    The different texts of a form are paired first, their documents are joined to these pairs, so that copies
    of one text never meet each other.
    """
    texts = cut(classes.select("g", "h").distinct())
    a, b = texts.withColumnRenamed("h", "h_1"), texts.withColumnRenamed("h", "h_2")
    met = a.join(b, "g").where("h_1 < h_2").select("h_1", "h_2")
    docs = [classes.select(F.col("doc_id").alias(f"x_{i}"), F.col("h").alias(f"h_{i}")) for i in (1, 2)]
    return met.join(docs[0], "h_1").join(docs[1], "h_2").select(F.least("x_1", "x_2").alias("id_1"), F.greatest("x_1", "x_2").alias("id_2")).where("id_1 < id_2").distinct()
