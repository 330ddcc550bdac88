"""Parameters of the catalogue queries.

The sample tables hold invented words, so the lexicons and the gazetteer list
words that do occur in them. Spanish has no entries: it plays the unsupported
language.
"""

from __future__ import annotations

from linkloom.operators.entities import Pattern, Surface
from linkloom.operators.labels import Label

CATEGORIES = {
    "en": [
        Label("nature", {"in": 1.0, "on": 1.0, "at": 0.5}),
        Label("history", {"was": 2.0, "from": 1.0, "of": 0.5}),
        Label("culture", {"and": 1.0, "with": 0.5}),
        Label("spirituality", {"that": 1.0, "for": 1.0, "of the": 2.0}),
        Label("architecture", {"is": 1.0, "by": 1.0, "it": 1.0}),
    ],
    "de": [
        Label("nature", {"der": 1.0, "auf": 2.0}),
        Label("history", {"die": 1.0, "von": 2.0}),
        Label("culture", {"und": 1.0, "mit": 2.0}),
    ],
    "fr": [
        Label("nature", {"la": 1.0, "dans": 2.0}),
        Label("history", {"de": 0.5, "des": 1.0}),
        Label("culture", {"et": 1.0, "de la": 2.0}),
    ],
}

TAGS = {
    "en": [
        Label("fortress", {"the": 1.0}),
        Label("bridge", {"of": 1.0}),
        Label("church", {"and": 1.0}),
        Label("waterfall", {"to": 1.0}),
        Label("lake", {"in": 1.0}),
        Label("monastery", {"is": 1.0}),
        Label("mountain", {"that": 1.0}),
        Label("museum", {"it": 1.0}),
        Label("river", {"for": 1.0}),
        Label("national park", {"of the": 1.0, "in the": 1.0}),
        Label("gallery", {"was": 1.0}),
        Label("beach", {"on": 1.0}),
        Label("park", {"with": 1.0}),
        Label("castle", {"be": 1.0}),
        Label("garden", {"as": 1.0}),
    ],
    "de": [Label("fortress", {"der": 1.0}), Label("church", {"und": 1.0}), Label("lake", {"die": 1.0})],
    "fr": [Label("fortress", {"de": 1.0}), Label("church", {"la": 1.0}), Label("lake", {"et": 1.0})],
}

GAZETTEER = {
    "en": [
        Surface("Orre", "LOC", 0.9),
        Surface("Eriner", "LOCATION", 0.8),
        Surface("Of the", "LOC", 0.6),
        Surface("The", "ORG", 0.7),
        Surface("And the", "ORGANIZATION", 0.95),
        Surface("That", "PER", 0.5),
        Surface("With", "PERSON", 0.3),
        Surface("Anon", "MISC", 0.85),
        Surface("Th", "GPE", 0.49),
    ],
    "de": [
        Surface("Nicht", "LOC", 0.9),
        Surface("Sich", "PER", 0.8),
        Surface("Und", "ORG", 0.4),
        Surface("Auf", "LOC", 0.7),
    ],
    "fr": [Surface("Sur", "LOC", 0.9), Surface("Elle", "PER", 0.9), Surface("Dans", "LOC", 0.55)],
}

PATTERNS = [Pattern(r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "CONTACT", 0.9)]
