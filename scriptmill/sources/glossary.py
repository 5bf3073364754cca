"""Glossary files: domain terms, confirmed confusions and anchors. Read and validated on the driver, since they are small and edited by hand; what queries use are DataFrames."""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass, field
from functools import cached_property

import regex
from pyspark.sql import DataFrame, SparkSession

from scriptmill.schema import GlossaryError

#: Categories whose terms are ordinary words as well (fixed values).
AMBIGUOUS_CATEGORIES = ("structure", "market")
MIN_WORD, MIN_SECOND = 4, 3

#: Ordinary words that neither are mis-heard terms nor anchor any.
STOP_WORDS = frozenset(
    """a an the and or but nor so if then than that this these those there here it its he she his her him they them their we us our you your i my me
    is are was were be been being am do does did done doing have has had having will would shall should can could may might must
    of to in on at by for from with without into onto over under about above below after before between through during against
    up down out off again once only just very too also not no yes all any both each few more most other some such same own
    what when where which who whom whose why how because while until since although though
    one two three first second third last next many much well good right left like look looks looking see seen say says said
    go goes going gone get gets getting got make makes made take takes took come comes came know knows think want need let
    now today still even ever never always often here back big small high low long short new old great little kind sort thing things
    way time times day days lot something anything nothing everything someone maybe probably really actually okay head near clear
    want able per via upon""".split()
)


def key_of(text: str) -> str:
    """The comparison key of a short text (the driver's twin of the column function)."""
    for ch in "​‌‍⁠﻿":
        text = text.replace(ch, "")
    folded = unicodedata.normalize("NFKC", text.replace(" ", " ")).lower()
    return " ".join(regex.sub(r"[^\p{L}\p{N}_\s]", " ", folded).split())


@dataclass(frozen=True)
class Term:
    id: str
    canonical: str
    category: str = "general"
    aliases: tuple[str, ...] = ()
    notes: str = ""
    spoken: str | None = None
    speak_original: bool = False

    @property
    def ambiguous(self) -> bool:
        return self.category in AMBIGUOUS_CATEGORIES

    @property
    def surfaces(self) -> tuple[str, ...]:
        return (self.canonical, *self.aliases)


def _surface_pattern(surface: str) -> str:
    """One spelling: words apart by white space, full stops optional."""
    return r"\s+".join(regex.escape(w, special_only=True).replace(r"\.", r"\.?") for w in surface.split())


def surface_key(text: str) -> str:
    """What a match and its surface have in common: lower case, single spaces, no full stops."""
    return " ".join(text.lower().replace(".", "").split())


@dataclass(frozen=True)
class Glossary:
    terms: tuple[Term, ...]
    confusions: tuple[tuple[str, str, str], ...] = ()  # wrong, right, note
    extra_anchors: tuple[tuple[str, str], ...] = ()
    stop_words: frozenset[str] = field(default=STOP_WORDS)

    @cached_property
    def ordered_surfaces(self) -> list[tuple[str, Term]]:
        """Longest pattern first, then in order of declaration."""
        return sorted(((s, t) for t in self.terms for s in t.surfaces), key=lambda x: -len(_surface_pattern(x[0])))

    @cached_property
    def pattern(self) -> str:
        """One alternation over all surfaces for Java and Python regexes: leftmost, longest, whole words, any case."""
        body = "|".join(_surface_pattern(s) for s, _ in self.ordered_surfaces)
        return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])" if body else r"(?!)"

    @cached_property
    def term_by_surface(self) -> dict[str, Term]:
        out: dict[str, Term] = {}
        for s, t in self.ordered_surfaces:
            out.setdefault(surface_key(s), t)
        return out

    def get(self, term_id: str) -> Term | None:
        return next((t for t in self.terms if t.id == term_id), None)

    def _usable(self, first: str, second: str) -> bool:
        return len(first) >= MIN_WORD and len(second) >= MIN_SECOND and not {first, second} & self.stop_words

    @cached_property
    def anchors(self) -> list[tuple[str, str]]:
        """Neighbouring words of canonical forms, then the extra anchors: usable ones, without repeats, in order."""
        pairs = [p for t in self.terms for w in [key_of(t.canonical).split()] for p in zip(w, w[1:], strict=False)]
        return [p for p in dict.fromkeys([*pairs, *self.extra_anchors]) if self._usable(*p)]

    @cached_property
    def vocabulary(self) -> frozenset[str]:
        return frozenset(w for t in self.terms for s in t.surfaces for w in key_of(s).split())

    def summary(self) -> dict:
        return {"term_count": len(self.terms), "categories": sorted({t.category for t in self.terms}), "translated_terms": sum(bool(t.spoken) for t in self.terms), "kept_in_english": sum(t.speak_original for t in self.terms)}

    # dimensions; a glossary is an edited file, so they are local relations that Spark broadcasts by their known size
    def terms_df(self, spark: SparkSession) -> DataFrame:
        rows = [(t.id, t.canonical, t.category, list(t.aliases), t.notes, t.spoken, t.speak_original, t.ambiguous) for t in self.terms]
        return spark.createDataFrame(rows, "id string, canonical string, category string, aliases array<string>, notes string, spoken string, speak_original boolean, ambiguous boolean")

    def anchors_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(self.anchors)], "first string, second string, anchor_seq int")

    def confusions_df(self, spark: SparkSession) -> DataFrame:
        rows = [(key_of(w), key_of(r), i) for i, (w, r, _) in enumerate(self.confusions) if key_of(w) and key_of(r)]
        return spark.createDataFrame(rows, "wrong string, right string, confusion_seq int")


def parse_glossary(payload: object) -> Glossary:
    """Validate the content of a glossary file."""
    def need(ok: object, what: str) -> None:
        if not ok:
            raise GlossaryError(what)

    need(isinstance(payload, dict), "a glossary is a JSON object")
    need(payload.get("schema_version") == 1, "glossary schema version must be 1")
    raw = payload.get("terms")
    need(isinstance(raw, list) and raw, "a glossary needs a non-empty list of terms")
    terms, ids = [], set()
    for i, t in enumerate(raw):
        need(isinstance(t, dict), f"term {i} is not an object")
        name, canonical, aliases, original = t.get("id"), t.get("canonical"), t.get("aliases", []), t.get("speak_original", False)
        need(isinstance(name, str) and name.strip(), f"term {i} has no id")
        need(isinstance(canonical, str) and canonical.strip(), f"term {name} has no canonical form")
        need(name not in ids, f"term id {name} occurs twice")
        need(isinstance(aliases, list), f"aliases of {name} are not a list")
        need(isinstance(original, bool), f"speak_original of {name} is not a boolean")
        ids.add(name)
        spoken = t.get("persian")
        terms.append(Term(name.strip(), canonical.strip(), str(t.get("category") or "general"), tuple(str(a).strip() for a in aliases if str(a).strip()), str(t.get("notes") or ""), spoken if isinstance(spoken, str) and spoken.strip() else None, original))
    confusions = []
    known = payload.get("known_confusions", [])
    need(isinstance(known, list), "known_confusions is not a list")
    for c in known:
        need(isinstance(c, dict) and isinstance(c.get("wrong"), str) and isinstance(c.get("right"), str), "a confusion needs the strings wrong and right")
        need(c["wrong"].strip() and c["right"].strip() and c["wrong"].strip().lower() != c["right"].strip().lower(), "a confusion needs two different words")
        confusions.append((c["wrong"], c["right"], str(c.get("note") or "")))
    anchors = []
    extra = payload.get("confusable_extra_anchors", [])
    need(isinstance(extra, list), "confusable_extra_anchors is not a list")
    for a in extra:
        need(isinstance(a, str) and len(key_of(a).split()) == 2, "an anchor is a string of two words")
        anchors.append(tuple(key_of(a).split()))
    return Glossary(tuple(terms), tuple(confusions), tuple(anchors))


def load_glossary(path: str) -> Glossary:
    try:
        with open(path, encoding="utf-8") as f:
            return parse_glossary(json.load(f))
    except (OSError, json.JSONDecodeError) as e:
        raise GlossaryError(f"{path}: {e}") from e
