"""Names and offices as people type them, in comparable parts."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.functions.civic import OFFICE_STOP_WORDS

#: a first name is in the vocabulary if it heads this share of the alias lists, so there are at most 1 / SHARE names;
#: what lists tell of the other names is joined as a table (``rare_relations``)
SHARE, LEAST_LISTS = 1 / 5000, 2
#: two names of the vocabulary are related if this share of the lists headed by one has the other, so a name has at most 1 / RELATED partners
RELATED = 0.03
#: a name within one edit of one that is this much more frequent is its misspelling
TYPO = 8
#: words and offices remembered by a task; beyond that it forgets all and goes on
REMEMBERED = 200_000

# Words around names.
TITLES = "dr rev mr mrs ms hon prof".split()
SUFFIXES = "jr sr ii iii iv phd esq md".split()
PARTICLES = "de la del der den di da du le van von st sta san mc mac o".split()
# Wordings of offices, the first that occurs decides.
BODIES = [
    ("treasurer", r"\btreas"), ("clerk", r"\bclerk\b"), ("mayor", r"\bmayor\b"), ("sheriff", r"\bsheriff\b"), ("judge", r"\bjudges?\b|\bmagistrate\b|\bjustice\b|\bcourt\b"), ("assessor", r"\bassessor\b"),
    ("recorder", r"\brecorder\b|\bregister\b"), ("coroner", r"\bcoroner\b"), ("auditor", r"\bauditor\b|\bcomptroller\b|\bcontroller\b"), ("surveyor", r"\bsurveyor\b"), ("constable", r"\bconstable\b|\bmarshal\b"),
    ("attorney", r"\battorney\b|\bprosecutor\b"), ("library", r"\blibrary\b"), ("water", r"\bwater\b|\birrigation\b|\bsanitary\b|\bsewer\b"), ("hospital", r"\bhospital\b|\bhealth\b"),
    ("fire", r"\bfire\b|\bfpd\b"), ("school", r"\bsch(?:ool)?s?\b|\beducation\b"), ("park", r"\bparks?\b"), ("township", r"\btwp\b|\btownship\b"), ("village", r"\bvillage\b"),
    ("council", r"\bcouncil\b|\bcncl\b|\bcounsel\b|\balderperson\b|\bcouncil(?:man|woman|member|or)\b|\balder(?:man|woman)\b"), ("county", r"\bcounty\b|\bco\b|\bcommissioner\b|\bsupervisors?\b"),
]
# Words that say nothing of a locality, beside those of the offices' table.
OFFICE_WORDS = set(OFFICE_STOP_WORDS) | set(
    "counsel cncl mbr common board co sch bd fire fpd protection parks park rec commission treas dist d town library water irrigation sanitary sewer hospital health court judges supervisors".split()
)
SHORT_PLACES = {"mt": "mount", "st": "saint", "ft": "fort", "sta": "saint"}
ROMAN = {r: i + 1 for i, r in enumerate("i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split())}

_TITLE = re.compile(rf"^(?:{'|'.join(TITLES)})\b\.?\s+")
_SUFFIX = re.compile(rf"[,\s]+(?:{'|'.join(SUFFIXES)})\.?$")
_WORD = re.compile(r"[a-z]+")
_BODIES = [(n, re.compile(p)) for n, p in BODIES]
_SEAT = re.compile(r"\b(?:district|dist|ward|area|d)\b[\s.\-]*([a-z]+|\d+)\b|\bd(\d+)\b")


def fold(s: str | None) -> str:
    """Lower case without accents, with single blanks; letters that do not decompose are spelled out by their base."""
    if not s:
        return ""
    s = unicodedata.normalize("NFKD", s).lower().replace("ł", "l").replace("ø", "o").replace("đ", "d").replace("ß", "ss").replace("ı", "i").replace("’", "'")
    return " ".join("".join(c for c in s if not unicodedata.combining(c)).split())


def near_keys(w: str) -> list[str]:
    """The word and every form with one letter left out: words within one edit or transposition share a key."""
    return [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]


def one_edit(a: str, b: str) -> bool:
    """Whether at most one insertion, deletion, substitution or transposition of neighbours leads from a to b."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (len(x) > 1 and x[:2] == y[1::-1] and x[2:] == y[2:])


@dataclass
class Vocabulary:
    """First names and how they are related; learned from the records' own alias lists."""

    count: dict[str, int] = field(default_factory=dict)
    related: dict[str, set[str]] = field(default_factory=dict)
    _near: dict[str, list[str]] = field(default_factory=dict)
    _snapped: dict[str, list[str]] = field(default_factory=dict)
    _spelled: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        heads = {n for n in self.count if len(n) >= 4}
        shared: dict[str, list[str]] = {}
        for n in sorted(heads):
            for k in near_keys(n):
                shared.setdefault(k, []).append(n)
        own = lambda a, b: self.related.get(a, set()) - self.related.get(b, set()) - {b}
        for n in {a for names in shared.values() for a in names for b in names if self.count[b] >= TYPO * self.count[a] and one_edit(a, b) and not own(a, b)}:
            del self.count[n]  # a frequent misspelling: it has no relatives that the other name lacks
        for n in self.count:
            if len(n) >= 4:
                for k in near_keys(n):
                    self._near.setdefault(k, []).append(n)
        # spellings of one name: within one edit, with a relative in common
        spellings = [(a, b) for names in self._near.values() for a in names for b in names if a != b and one_edit(a, b) and self.related.get(a, set()) & self.related.get(b, set())]
        inherited = {a: {b, *self.related[b]} - {a} for a, b in spellings}
        for a, more in inherited.items():
            self.related[a] |= more
            for b in more:
                self.related[b].add(a)

    def known(self, given: str) -> int:
        """How surely a text is a given name: 2 has a name, 1 a misspelled or abbreviated one, 0 neither."""
        words = [w for w in re.finditer(r"([a-z]+)(\.?)", given) if len(w[1]) > 1]
        if any(w[1] in self.count for w in words):
            return 2
        return int(any(self.snap(w[1]) or (w[2] and len(w[1]) > 2 and self.spelled_by(w[1])) for w in words))

    def snap(self, w: str) -> list[str]:
        """The vocabulary's names for a typed word: itself, or those within one edit (words of 4 letters or more)."""
        if w in self.count:
            return [w]
        if len(w) < 4:
            return []
        if w not in self._snapped:
            self._forget(self._snapped)[w] = sorted({n for k in near_keys(w) for n in self._near.get(k, ()) if one_edit(w, n)})
        return self._snapped[w]

    @staticmethod
    def _forget(memory: dict) -> dict:
        if len(memory) > REMEMBERED:
            memory.clear()
        return memory

    def spelled_by(self, short: str) -> list[str]:
        """Names that an abbreviation with a full stop can stand for: their beginning, or letters in order from first to last."""

        def inside(n: str) -> bool:
            rest = iter(n)
            return len(n) > len(short) and n[0] == short[0] and (n.startswith(short) or n[-1] == short[-1]) and all(c in rest for c in short)

        if short not in self._spelled:
            self._forget(self._spelled)[short] = sorted(n for n in self.count if inside(n))
        return self._spelled[short]


def alias_counts(records: DataFrame) -> DataFrame:
    """head, other, n: how many alias lists begin with head and hold other (head itself for their number)."""
    plain = F.filter(F.transform(F.from_json("first_name_aliases", "array<string>"), lambda x: F.lower(F.translate(x, "áàâäãåéèêëíìîïóòôöõúùûüçñýÿğćčšž", "aaaaaaeeeeiiiiooooouuuucnyygccsz"))), lambda x: x.rlike("^[a-z]{2,}$"))
    lists = records.select("unique_id", "first_name_aliases").distinct().select(F.array_distinct(plain).alias("l")).where(F.size("l") > 0)
    return lists.select(F.get("l", F.lit(0)).alias("head"), F.explode("l").alias("other")).groupBy("head", "other").agg(F.count(F.lit(1)).alias("n"))


def learn_vocabulary(records: DataFrame) -> Vocabulary:
    """The vocabulary of a table with first_name_aliases. What comes to the driver is bounded by SHARE and RELATED, not by the table."""
    counts = alias_counts(records)
    heads = counts.where("head = other").select("head", F.col("n").alias("lists"))
    least = F.greatest(F.lit(LEAST_LISTS), F.coalesce(F.sum("lists"), F.lit(0)) * SHARE)
    named = heads.crossJoin(F.broadcast(heads.agg(least.alias("least")))).where("lists >= least").select("head", "lists")
    pairs = counts.where("head <> other").join(named, "head").where(F.col("n") >= F.greatest(F.least(F.lit(2.0), F.col("lists") * 0.1), F.col("lists") * RELATED)).join(named.select(F.col("head").alias("other")), "other", "left_semi")
    count = {r.head: r.lists for r in named.collect()}
    related: dict[str, set[str]] = {}
    for r in pairs.select("head", "other").collect():
        related.setdefault(r.head, set()).add(r.other)
        related.setdefault(r.other, set()).add(r.head)
    return Vocabulary(count, related)


def surname_key(s: str) -> str:
    return "".join(_WORD.findall(s.replace("'", "")))


def surname_parts(s: str) -> list[str]:
    """The surnames in a compound of two or more; none for a simple surname. Particles belong to what follows."""
    parts, lead = [], ""
    for w in re.split(r"[\s\-]+", s.replace("'", "")):
        w = "".join(_WORD.findall(w))
        if w in PARTICLES or len(w) < 3:
            lead += w
        elif w:
            parts.append(lead + w)
            lead = ""
    return parts if len(parts) > 1 else []


def split_name(first: str | None, last: str | None, vocabulary: Vocabulary) -> tuple[str, str]:
    """(given part, surname part), folded, without titles and suffixes, also if they share a field or are exchanged."""
    f, s = fold(first), fold(last)
    for _ in range(2):
        f, s = _TITLE.sub("", f), _TITLE.sub("", s)
        f, s = _SUFFIX.sub("", " " + f).strip(), _SUFFIX.sub("", " " + s).strip()
    for whole, other in ((f, s), (s, f)):
        if whole and not other:
            if "," in whole:
                s, f = (x.strip() for x in whole.split(",", 1))
            elif " " in whole:
                f, s = whole.split(" ", 1)
                while len(s.split()) > 1 and re.fullmatch(r"[a-z]\.?|[\"(].*[\")]", s.split()[0]):  # middle initials and nicknames stay with the given name
                    m, s = s.split(" ", 1)
                    f = f"{f} {m}"
            break
    if f and s:
        initials = lambda x: all(len(w) == 1 for w in _WORD.findall(x))
        if (vocabulary.known(s) > vocabulary.known(f) and not initials(f)) or (initials(s) and not initials(f)):
            f, s = s, f
    return f, s


def short_stem(x: str) -> str:
    """What a familiar short form has in common with the full name: eddie -> ed, kenny -> ken, nick -> nic; '' if too little is left."""
    s = re.sub(r"(?<=..)(?:ie|ey|y|i)$", "", x)
    s = re.sub(r"(.)\1$", r"\1", s)
    s = re.sub("ck$", "c", s)
    return s if len(s) > 2 or len(x) == 2 or s != x and len(s) == 2 else ""


def given_names(given: str, aliases: list[str], vocabulary: Vocabulary) -> tuple[list[str], list[str], list[str], list[str], bool]:
    """(forms, wider, letters, stems, initial): names the given part and the aliases stand for, with their relatives, the
    letters they can begin with, the stems of forms that the vocabulary relates to nothing, and whether the part is initials alone.
    """
    lead: list[str] = []
    for m in re.finditer(r"([a-z]+)(\.?)", given):
        if len(m[1]) > 1:  # further words are middle names
            lead = (m[2] and m[1] not in vocabulary.count and vocabulary.spelled_by(m[1])) or vocabulary.snap(m[1]) or [m[1]]
            break
    others = [*re.findall(r"[\"(]\s*([a-z]{2,})", given), *(x for x in map(fold, aliases) if re.fullmatch("[a-z]{2,}", x))]
    for x in others:
        lead = lead + (vocabulary.snap(x) or [x])
    first = (_WORD.findall(given) or [""])[0][:1]
    forms = list(dict.fromkeys(lead))
    wider = sorted(set(forms).union(*(vocabulary.related.get(x, ()) for x in forms)))
    initial = bool(first) and all(len(w) == 1 for w in _WORD.findall(given))
    stems = sorted({t for x in forms if not vocabulary.related.get(x) and (t := short_stem(x))})
    return forms, wider, sorted({x[0] for x in wider} | ({first} if initial else set())), stems, initial


def body_of(*texts: str | None) -> str:
    """The body an office belongs to, by the first text that tells; an office of no known wording is a body of its own type."""
    for t in texts:
        s = fold(t).replace(".", "")
        for name, pattern in _BODIES:
            if pattern.search(s):
                return name
    return next((" ".join(_WORD.findall(fold(t))) for t in texts[1:] if t and t.strip()), "")


def place_of(office: str | None, *types: str | None) -> str:
    """The locality in an office's wording: what is left without the words of offices and seats, and of the office's types."""
    words, typed = re.findall(r"[a-z]+\d*|\d+", fold(office).replace("'", "")), {w for t in types for w in _WORD.findall(fold(t))}
    return " ".join(SHORT_PLACES.get(w, w) for w in words if w not in OFFICE_WORDS and w not in typed and w not in ROMAN and not re.fullmatch(r"d?\d+", w))


def _number(w: str | None) -> str:
    if not w:
        return ""
    if w.isdigit():
        return str(int(w)) if int(w) else ""
    return str(ROMAN[w]) if w in ROMAN else ""


def seat_of(identifier: str | None, office: str | None, raw: str | None) -> str:
    """The seat's number as text, '' if unknown; the identifier counts before the office's wording and the raw text."""
    s = fold(identifier)
    if m := re.search(r"(\d+)(?:\.0)?(?:st|nd|rd|th)?\s*$", s):
        if n := _number(m[1]):
            return n
    elif s and (n := _number(re.split(r"[\s\-.]+", s)[-1])):
        return n
    for t in (fold(office), fold(raw)):
        for m in _SEAT.finditer(t):
            if n := _number(m[1] or m[2]):
                return n
        if t and (n := _number(re.sub(r"[^a-z0-9]", "", t.split()[-1]))):
            return n
    return ""


PARTS = "unique_id string, source_name string, state string, place string, body string, seat string, surname string, surname_parts array<string>, forms array<string>, wider array<string>, letters array<string>, stems array<string>, rare array<string>, initial boolean, email string, phone string"


def parts_of_records(records: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per unique_id (the first of repeated rows in order of their values) with its name and office in parts.

    Null or blank names give empty parts, null states ''. Placeholder contacts are not told apart here.
    """
    optional = [c for c in ("city", "office_type", "candidate_office", "district_raw", "district_identifier") if c in records.columns]
    cols = ["source_name", "state", "first_name", "last_name", "first_name_aliases", "official_office_name", "email", "phone", *optional]
    # a fixed number of partitions, else few tasks would parse all the names of a small table
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = records.where(F.col("unique_id").isNotNull()).select("unique_id", *cols).repartition(parts, "unique_id").groupBy("unique_id").agg(F.min(F.struct(*cols)).alias("r")).select("unique_id", "r.*")
    at = {c: i for i, c in enumerate(["unique_id", *cols])}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        offices: dict[tuple, tuple[str, str, str]] = {}

        def office_parts(office, city, kind, wanted, identifier, raw) -> tuple[str, str, str]:
            key = (office, city, kind, wanted, identifier, raw)
            if key not in offices:
                if len(offices) > REMEMBERED:
                    offices.clear()
                offices[key] = place_of(city or office, kind, wanted) or place_of(office, kind, wanted), body_of(office, wanted, kind), seat_of(identifier, office, raw)
            return offices[key]

        for f in frames:
            rows = []
            for r in f.itertuples(index=False, name=None):
                get = lambda c: r[at[c]] if c in at and isinstance(r[at[c]], str) else None  # noqa: B023, E731
                given, surname = split_name(get("first_name"), get("last_name"), vocabulary)
                try:
                    aliases = [a for a in json.loads(get("first_name_aliases") or "[]") if isinstance(a, str)]
                except (ValueError, TypeError):
                    aliases = []
                key = surname_key(surname)
                aliases = [a for a in aliases if surname_key(fold(a)) != key]
                forms, wider, letters, stems, initial = given_names(given, aliases, vocabulary)
                place, body, seat = office_parts(*map(get, ("official_office_name", "city", "office_type", "candidate_office", "district_identifier", "district_raw")))
                digits = re.sub(r"\D", "", get("phone") or "")[-10:]
                rows.append((
                    r[0], get("source_name"), get("state") or "", place, body, seat, key, surname_parts(surname), forms, wider, letters, stems, [x for x in forms if x not in vocabulary.count], initial,
                    (get("email") or "").strip().lower() or None, digits if len(digits) == 10 else None,
                ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])

    return once.mapInPandas(run, PARTS)


def rare_relations(records: DataFrame) -> DataFrame:
    """x, y, both ways: names that two alias lists or more hold together, whatever their share; a table, however many there are."""
    said = alias_counts(records).where("head <> other").select(F.least("head", "other").alias("x"), F.greatest("head", "other").alias("y"), "n").groupBy("x", "y").agg(F.sum("n").alias("n")).where("n >= 2")
    return said.select("x", "y").unionByName(said.select(F.col("y").alias("x"), F.col("x").alias("y")))
