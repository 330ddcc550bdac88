"""License scans with a positional index of rare licence words, in DataFrame functions only.

The index holds the words of licence templates with their places in them. A
file's words are weighed by how few documents have them; for each template that it
may hold, the file's weightiest words are looked up. Where a word is in the file
and where it is in the template tell where the template would start; starts on
which two words agree are verified by the template's key phrases, word by word.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word of a file, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A file's weightiest words that are looked up per template.
LOOKED_UP = 3


@dataclass(frozen=True)
class Template:
    """Text of a licence or of its notice; ``keys`` must stand at their places, and none of ``not_next`` behind the last."""

    label: str
    text: str
    keys: tuple[str, ...]
    not_next: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_places(self) -> list[tuple[int, list[str]]]:
        out, at = [], 0
        for key in self.keys:
            words = key.split()
            while self.words[at : at + len(words)] != words:
                at += 1
                if at > len(self.words):
                    raise ValueError(f"{self.label}: the text lacks the key phrase {key!r}")
            out.append((at, words))
            at += len(words)
        return out


# Phrases whose places are counted, with their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Passages of public licences and of their usual notices.
TEMPLATES = [
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted", "appear in all copies"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("use this file except in compliance with the license",),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("redistribute it and or modify it", "gnu general public license as published by the free software foundation"),
    ),
    Template("gpl-2", "gnu general public license version 2", ("general public license version 2",)),
    Template("gpl-3", "gnu general public license version 3", ("general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("terms of the mozilla public license",),
    ),
    Template("epl", "the terms of the eclipse public license", ("eclipse public license",)),
    Template("boost", "boost software license version 1 0", ("boost software license",)),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software",
        ("authors be held liable for any damages arising from the use of this software",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    Template("cc-by", "licensed under cc by", ("cc by",), ("nc", "nd", "sa")),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",), ("nd", "sa")),
    Template("cc-by-nc-sa", "licensed under cc by nc sa", ("cc by nc sa",)),
    Template("cc-by-nc-nd", "licensed under cc by nc nd", ("cc by nc nd",)),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international license",),
    ),
    Template(
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
        ("noderivatives", "sharealike"),
    ),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("universal public domain dedication",)),
]


def all_templates(more: Sequence[Template] = TEMPLATES) -> list[Template]:
    """The base phrases, each a template that is its own key, and the others."""
    return [Template(label, phrase, (phrase,), base=True) for phrase, label in BASE.items()] + list(more)


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def lowered(text: Column) -> Column:
    """A-Z lower-cased. Plain ASCII takes the fast way, which does the same there."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(name: str = "text") -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(F.col(name), F.lit(""))), F.lit(WORD), F.lit(0))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def document_counts(docs: DataFrame, templates: Sequence[Template]) -> dict[str, int]:
    """In how many rows each licence word is; ``''`` is in all. At most one entry per word of the templates."""
    found = F.concat(F.array_intersect(words_of(), _strings(vocabulary(templates))), _strings([""]))
    return {r[0]: r[1] for r in docs.select(F.explode(found).alias("word")).groupBy("word").count().collect()}


def weight(count: int, rows: int) -> int:
    """Rarity of a word in whole thousandths, at least 1."""
    return 1 + math.floor(1000 * math.log((rows + 1) / (count + 1)))


INDEX = """array<struct<label:string, base:boolean, words:array<string>, weights:array<bigint>, whole:bigint,
ranked:array<string>, places:array<struct<w:string, at:int>>, needed:array<string>,
keys:array<struct<at:int, words:array<string>>>, end:int, not_next:array<string>>>"""


def index(templates: Sequence[Template], counts: Mapping[str, int]) -> Column:
    """The positional index as one constant array: a struct per template."""
    rows = counts.get("", 0)
    weights = {w: weight(counts.get(w, 0), rows) for w in vocabulary(templates)}
    out = []
    for t in templates:
        keys = t.key_places()
        out.append(
            {
                "label": t.label,
                "base": t.base,
                "words": t.words,
                "weights": [weights[w] for w in t.words],
                "whole": sum(weights[w] for w in t.words),
                "ranked": sorted(set(t.words), key=lambda w: (-weights[w], w)),
                "places": [{"w": w, "at": i} for i, w in enumerate(t.words)],
                "needed": sorted({w for _, words in keys for w in words}),
                "keys": [{"at": at, "words": words} for at, words in keys],
                "end": keys[-1][0] + len(keys[-1][1]),
                "not_next": list(t.not_next),
            }
        )
    return F.from_json(F.lit(json.dumps(out)), INDEX)


def _chosen(template: Column, known: Column) -> Column:
    """The file's weightiest words of a template."""
    return F.slice(F.filter(template["ranked"], lambda w: F.array_contains(known, w)), 1, LOOKED_UP)


def _starts(template: Column, chosen: Column, hits: Column) -> Column:
    """Places where the template would begin by two of the chosen words, or by its only one."""

    def offsets(at: int) -> Column:
        word = F.get(chosen, F.lit(at))
        mine = F.filter(hits, lambda h: h["w"] == word)
        places = F.filter(template["places"], lambda p: p["w"] == word)
        each = F.transform(places, lambda p: F.transform(mine, lambda h: h["i"] - p["at"]))
        return F.array_distinct(F.flatten(each))

    pairs = [F.array_intersect(offsets(a), offsets(b)) for a, b in ((0, 1), (0, 2), (1, 2))]
    return F.when(F.size(template["ranked"]) == 1, offsets(0)).otherwise(F.array_distinct(F.concat(*pairs)))


def _verified(template: Column, start: Column, words: Column) -> Column:
    def stands(key: Column) -> Column:
        at = start + key["at"]
        return F.when(at >= 0, F.slice(words, at + 1, F.size(key["words"])) == key["words"]).otherwise(F.lit(False))

    behind = F.get(words, start + template["end"])
    return F.forall(template["keys"], stands) & ~F.coalesce(F.array_contains(template["not_next"], behind), F.lit(False))


def _covered(template: Column, start: Column, words: Column) -> Column:
    """Share of the template's weight whose words stand in their places."""
    at = F.sequence(F.lit(0), F.size(template["words"]) - 1)
    same = lambda i: F.coalesce(F.get(words, start + i) == F.get(template["words"], i), F.lit(False))
    held = F.aggregate(
        at, F.lit(0).cast("long"), lambda sum_, i: sum_ + F.when(same(i), F.get(template["weights"], i)).otherwise(F.lit(0).cast("long"))
    )
    return held.cast("double") / template["whole"].cast("double")


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """``(doc_id, n_words, found)`` of every row of ``docs (doc_id, text)``.

    ``found`` holds ``(label, base, start, covered)`` of every place where a
    template or base phrase is verified. Base phrases are found at all their
    places: they have at most ``LOOKED_UP`` words, and all of them are looked up.
    Null text is empty text. Repeated rows give repeated rows and count as often
    in the weights; other columns are not read. Counting the weights is a job; the
    counts, one per word of the templates, are all that reaches the driver.
    """
    both = all_templates(templates)
    for t in both:
        if re.findall(WORD, t.text) != t.words or (t.base and len(set(t.words)) > LOOKED_UP):
            raise ValueError(f"not a template: {t.text}")
    known = F.array_intersect(F.col("words"), _strings(vocabulary(both)))
    possible = F.filter(index(both, document_counts(docs, both)), lambda t: F.size(F.array_except(t["needed"], F.col("known"))) == 0)
    rows = docs.select(F.col("doc_id").cast("long"), words_of().alias("words"))
    rows = rows.select("doc_id", "words", known.alias("known")).select("doc_id", "words", "known", possible.alias("possible"))
    wanted = F.array_distinct(F.flatten(F.transform("possible", lambda t: _chosen(t, F.col("known")))))
    rows = rows.select("doc_id", "words", "known", "possible", wanted.alias("wanted"))
    placed = F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(placed, lambda h: F.array_contains(F.col("wanted"), h["w"]))
    no_hits = F.lit(None).cast("array<struct<w:string,i:int>>")
    rows = rows.withColumn("hits", F.when(F.size("wanted") > 0, hits).otherwise(no_hits))

    def places(t: Column) -> Column:
        starts = F.filter(_starts(t, _chosen(t, F.col("known")), F.col("hits")), lambda s: _verified(t, s, F.col("words")))
        return F.transform(
            starts,
            lambda s: F.struct(
                t["label"].alias("label"), t["base"].alias("base"), s.alias("start"), _covered(t, s, F.col("words")).alias("covered")
            ),
        )

    found = F.flatten(F.transform("possible", places))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), found.alias("found"))


def licences(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per row of ``docs``: words, base places, labels, and the best coverage of a template as ``score``.

    ``first_word`` and ``last_word`` are null without a base place, labels are
    empty and the score is 0 where nothing is found.
    """
    found = scan(docs, templates)
    base = F.transform(F.filter("found", lambda f: f["base"]), lambda f: f["start"].cast("long"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base).alias("first_word"),
        F.array_max(base).alias("last_word"),
        joined(F.transform(F.filter("found", lambda f: f["base"]), lambda f: f["label"])).alias("base_labels"),
        joined(F.transform("found", lambda f: f["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["covered"])), F.lit(0.0)).alias("score"),
    )
