"""Entity lists: grouping, cleaning and the primary location (native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import let, strip

# Entity types by group; every other type is "misc".
GROUPS = {
    "locations": ["LOC", "LOCATION"],
    "organizations": ["ORG", "ORGANIZATION"],
    "persons": ["PER", "PERSON"],
}
FIELDS = ("locations", "organizations", "persons", "misc")
MIN_SCORE = 0.5

# Keys that may hold places, in order of preference.
LOCATION_KEYS = [
    "LOC", "GPE", "LABEL_0", "LABEL_1", "locations", "location", "LOCATION", "places",
]

# Generic words that are not a place by themselves.
SKIP_WORDS = [
    "lake", "river", "mountain", "church", "monastery", "fortress", "castle",
    "museum", "park", "reserve", "forest", "canyon", "waterfall", "cave", "beach",
    "bridge", "tower", "temple", "small", "big", "large", "old", "new", "ancient",
    "historic", "national", "state", "regional", "local", "main", "central",
    "озеро", "река", "гора", "церковь", "монастырь", "крепость", "замок", "музей",
    "парк", "заповедник", "лес", "каньон", "водопад", "пещера", "пляж", "мост",
    "башня", "храм", "собор", "зеленый", "старый", "новый", "древний", "святого",
    "святой",
]
MIN_LOCATION_LENGTH = 4
MIN_LETTER_SHARE = 0.7

ENTITY_TYPE = "array<struct<word:string,entity_group:string,score:double,pos:int>>"
RECORD_TYPE = "struct<" + ",".join(f"{f}:array<string>" for f in FIELDS) + ">"


def entity_group(kind: Column) -> Column:
    """Model label to one of the four groups."""
    rule = F
    for group, kinds in GROUPS.items():
        rule = rule.when(kind.isin(kinds), group)
    return rule.otherwise("misc")


def above_score(entities: Column, min_score: float = MIN_SCORE) -> Column:
    """Entities with at least ``min_score``."""
    return F.filter(entities, lambda e: e["score"] >= min_score)


def empty_record() -> Column:
    return F.struct(*[F.array().cast("array<string>").alias(f) for f in FIELDS])


def entity_record(entities: Column, min_score: float = MIN_SCORE) -> Column:
    """Four lists of distinct stripped words, in order of first appearance."""
    kept = above_score(entities, min_score)

    def field(name: str) -> Column:
        same = F.filter(kept, lambda e: entity_group(e["entity_group"]) == name)
        return F.array_distinct(F.transform(same, lambda e: strip(e["word"])))

    record = F.struct(*[field(f).alias(f) for f in FIELDS])
    return F.when(entities.isNull(), empty_record()).otherwise(record)


def entity_map(entities: Column) -> Column:
    """Map from raw entity type to its distinct words; no score limit, words as found."""
    kinds = F.array_distinct(F.transform(entities, lambda e: e["entity_group"]))
    pairs = F.transform(
        kinds,
        lambda kind: F.struct(
            kind,
            F.array_distinct(
                F.transform(F.filter(entities, lambda e: e["entity_group"] == kind), lambda e: e["word"])
            ),
        ),
    )
    empty = F.create_map().cast("map<string,array<string>>")
    return F.coalesce(F.map_from_entries(pairs), empty)


def record_size(record: Column) -> Column:
    """Number of entities in a four-list record, 0 for a missing one."""
    sizes = [F.coalesce(F.size(record[f]), F.lit(0)) for f in FIELDS]
    return F.coalesce(sum(sizes[1:], sizes[0]), F.lit(0))


def map_size(entities: Column) -> Column:
    """Number of words over all types of an entity map, 0 for a missing one."""
    total = F.aggregate(F.map_values(entities), F.lit(0), lambda n, v: n + F.coalesce(F.size(v), F.lit(0)))
    return F.coalesce(total, F.lit(0))


def parse_entity_json(text: Column) -> Column:
    """JSON text to a map of raw value texts; anything but an object gives an empty map.

    The values stay JSON because one object may mix strings, lists of strings and
    lists of objects.
    """
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(text, "map<string,string>"), empty)


def clean_piece(word: Column) -> Column:
    """Remove word-piece marks and outer whitespace."""
    return strip(F.replace(word, F.lit("##"), F.lit("")))


def is_place_name(word: Column) -> Column:
    """Long enough, mostly letters and not a generic word."""
    letters = F.length(F.regexp_replace(word, r"[^\p{L}]", ""))
    return (
        (F.length(word) >= MIN_LOCATION_LENGTH)
        & ~F.lower(word).isin(SKIP_WORDS)
        & (letters >= F.length(word) * MIN_LETTER_SHARE)
    )


def _longest(words: Column) -> Column:
    """Longest word; the first one among equals; ``''`` if there is none."""
    by_length = F.array_sort(words, lambda a, b: F.length(b) - F.length(a))
    return F.coalesce(F.try_element_at(by_length, F.lit(1)), F.lit(""))


def longest_place(words: Column, pieces_marked: bool = True) -> Column:
    """Best place name of a word list.

    ``pieces_marked`` drops words that begin with ``##``, as such a word is the
    tail of another one.
    """
    kept = F.filter(words, lambda w: ~w.startswith("##")) if pieces_marked else words
    return _longest(F.filter(F.transform(kept, clean_piece), is_place_name))


def _location_keys() -> Column:
    return F.array(*[F.lit(k) for k in LOCATION_KEYS])


def primary_location(entities: Column) -> Column:
    """Longest place name of an entity map, looking through the location keys in order."""

    def words(found: Column) -> Column:
        lists = F.transform(_location_keys(), lambda k: F.try_element_at(found, k))
        return F.flatten(F.filter(lists, lambda x: x.isNotNull()))

    return F.coalesce(longest_place(let(entities, words)), F.lit(""))


def primary_location_of_record(record: Column) -> Column:
    """As ``primary_location`` for a four-list record, whose only place field is ``locations``."""
    return longest_place(F.coalesce(record["locations"], F.array().cast("array<string>")))


def primary_location_of_json(text: Column) -> Column:
    """As ``primary_location`` for JSON text of any of the known shapes.

    A value may be a list of strings, a list of objects with ``text`` or
    ``word``, a mixture of both, or one bare string.
    """

    def words(raw: Column, key: Column) -> Column:
        value = F.try_element_at(raw, key)
        items = F.from_json(value, "array<string>")
        is_list = F.ltrim(value).startswith("[")

        def word(item: Column) -> Column:
            fields = F.from_json(item, "struct<text:string,word:string>")
            named = F.coalesce(fields["text"], fields["word"], F.lit(""))
            plain = F.when(item.startswith("##"), F.lit("")).otherwise(item)
            return clean_piece(F.when(item.startswith("{"), named).otherwise(plain))

        found = F.when(is_list, F.transform(items, word)).otherwise(F.array(clean_piece(value)))
        return F.filter(F.coalesce(found, F.array().cast("array<string>")), is_place_name)

    def all_words(raw: Column) -> Column:
        return F.flatten(F.transform(_location_keys(), lambda key: words(raw, key)))

    return F.coalesce(_longest(let(parse_entity_json(text), all_words)), F.lit(""))
