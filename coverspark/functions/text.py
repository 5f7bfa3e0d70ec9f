"""Names and text: column expressions for species names, habits, ids and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a rank, number of name words per rank, and words of a habit, first match wins.
VARIETY, SUBSPECIES, GENUS = ["var"], ["ssp", "subsp"], ["spp", "species", "sp", "s"]
RANK_WORDS = {"family": 1, "genus": 1, "species": 2, "subspecies": 4, "variety": 4, "form": 4}
HABIT_RULES = {
    "ava": [("other", ["algae", "cyanobacteria", "crust", "fungus", "unknown"]), ("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("graminoid", ["grass"]), ("{leaf} shrub", ["shrub"]), ("{leaf} tree", ["tree"])],
    "akveg": [("other", ["algae", "fungus"]), ("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("{leaf} shrub", ["shrub"])],
    "neon": [("other", ["unknown", "cyanobacteria", "fungus", "dead", "wood"]), ("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("bare ground", ["rock", "soil", "salt"]), ("{leaf} shrub", ["shrub"])],
    "nga": [("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("{leaf} shrub", ["shrub"]), ("{leaf} tree", ["tree"]), ("bare ground", ["soil", "rock"]), ("water", ["water"])],
    "abr": [("other", ["algae", "crust", "fungus"]), ("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("litter", ["litter", "scat"]), ("bare ground", ["bare ground", "mineral"]), ("{leaf} shrub", ["shrub"])],
    "rava": [("bryophyte", ["moss", "liverwort"]), ("forb", ["spore-bearing"]), ("{leaf} shrub", ["shrub"]), ("{leaf} tree", ["tree"])],
}
# Ranks of names that the checklist lacks.
RANK_OVERRIDES = {
    "algae": "type",
    "bare ground": "type",
    "bryophyte": "type",
    "forb": "type",
    "other": "type",
    "lichen": "type",
    "graminoid": "type",
    "Lepraria membranacea (Dicks.) Vain.": "species",
    "litter": "type",
    "Pedicularis arctoeuropaea (Hultén) Molau & D.F. Murray": "species",
    "Polyblastia bryophila Lonnr.": "species",
    "Rhizocarpon disporum (Naeg. ex Hepp) Müll. Arg.": "species",
    "Salix brachycarpa Nutt.": "species",
    "Schistidium holmenianum Steere & Brassard": "species",
    "water": "type",
    "Xanthoria (Fr.) Th. Fr.": "genus",
}
# Published names of subsources.
SUBSOURCES = {
    "Prudhoe Bay Airport ArcSEES Donald Walker": "Prudhoe Bay Airport ArcSEES Walker (pub 2016)",
    "Prudhoe ArcSEES road study Donald Walker": "Prudhoe ArcSEES road study Walker (pub 2015)",
    "Flux Tower Zona Scott Davidson": "Flux Tower Zona Davidson (pub 2016)",
    "Barrow DOE NGEE Victoria Sloan": "Barrow DOE NGEE Sloan (pub 2014)",
    "Atqasuk Vera Komarkova": "Atqasuk Villarreal (pub 2013)",
    "Barrow IBP Tundra Biome Pat Webber": "Barrow IBP Tundra Biome Villarreal (pub 2012)",
}
SUBSOURCES_OF_SITES = {"TOOL": "Toolik Field Station NEON (pub 2021)", "BARR": "Utqiagvik-Barrow NEON (pub 2021)"}
# Columns and the misspelt twins that fill them.
TWIN_COLUMNS = {
    "LONGITUDE WGS 84 (DD)": "LONGITUDEWGS84'(DD)",
    "HABITAT TYPE": "HABITAT TYPE ",
    "REMARKS": "REBMARKS",
    "SITE MOISTURE": "SITEMOISTURE",
    "RELEVE NUMBER": "RELEVE_NUMBER",
}
#: Starts of an author, in the order in which they are looked for.
AUTHOR_STARTS = [r"\(", r"s\.l\.?\b", r"[A-Z]{2,}\.", r"[A-Z][a-z]+\.", r"[A-Z]\."]


def words(c: Column) -> Column:
    """White-space separated words; an empty array for blank text."""
    return F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")


def genus_species(c: Column) -> Column:
    """Join key of a name: genus and species, the genus alone if no species is named, null for blank."""
    w = words(c)
    two = F.slice(w, 1, 2)
    key = F.when((F.size(two) < 2) | F.array_contains(two, "species"), F.try_element_at(two, F.lit(1)))
    return F.when(F.size(w) > 0, key.when(F.element_at(two, 1) == "unknown", F.element_at(two, 2)).otherwise(F.array_join(two, " ")))


def first_word(c: Column) -> Column:
    return F.try_element_at(words(c), F.lit(1))


def split_author(c: Column) -> Column:
    """struct(taxon, author): cut at the white space before the first kind of author start that occurs."""
    cut = F.coalesce(*[F.nullif(F.regexp_instr(c, F.lit(r"\s(?=" + p + ")")), F.lit(0)) for p in AUTHOR_STARTS])
    taxon = F.when(cut.isNotNull(), F.substring(c, F.lit(1), cut - 1)).otherwise(c)
    author = F.when(cut.isNotNull(), F.substring(c, cut, F.length(c))).otherwise(F.lit(""))
    return F.struct(F.trim(taxon).alias("taxon"), F.trim(author).alias("author"))


def clean_name(c: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), r"\(.*?\)", ""), r"[^a-z\s]", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def normalize_by_rank(c: Column, rank: Column) -> Column:
    n = F.coalesce(*[F.when(F.lower(rank) == k, F.lit(v)) for k, v in RANK_WORDS.items()], F.size(words(clean_name(c))))
    return F.array_join(F.slice(words(clean_name(c)), F.lit(1), n), " ")


def infer_rank(c: Column) -> Column:
    """Rank by the first marker word and its place; without one by the number of words."""
    w = F.regexp_extract_all(F.lower(c), F.lit(r"\b[a-z]+\b"), F.lit(0))
    mark = F.filter(F.transform(w, lambda x, k: F.struct(x.alias("w"), k.alias("k"))), lambda s: s["w"].isin(VARIETY + SUBSPECIES + GENUS))
    first, late = F.try_element_at(mark, F.lit(1)), F.try_element_at(mark, F.lit(1))["k"] >= 2
    by_mark = F.when(first["w"].isin(VARIETY), F.when(late, "variety").otherwise("genus")).when(first["w"].isin(SUBSPECIES), F.when(late, "subspecies").otherwise("genus")).when(first["w"].isin(GENUS), F.when(late, "subspecies").otherwise("genus"))
    return F.coalesce(by_mark, F.when(F.size(w) <= 1, "genus").when(F.size(w) == 2, "species").otherwise("subspecies"))


def author_by_rank(c: Column, rank: Column) -> Column:
    """Words after the name's own; null for families and types, and where none is left."""
    n = F.when(rank == "genus", 1).when(rank == "species", 2).when(rank.isin("subspecies", "variety", "form"), 4)
    w = words(c)
    return F.when(n.isNotNull() & (F.size(w) > n), F.array_join(F.slice(w, n + 1, F.size(w)), " "))


def camel_to_snake(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(c, "(.)([A-Z][a-z]+)", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2"))


def int_text(c: Column) -> Column:
    """Text of a whole number without its decimals; other text unchanged."""
    d = c.try_cast("double")
    return F.when((d == F.floor(d)) & (F.abs(d) < 1e15), d.cast("long").cast("string")).otherwise(c)


def unique_list(c: Column) -> Column:
    """Distinct, sorted, trimmed parts of a comma list as comma text."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.split(F.regexp_replace(c, "[\"'\\[\\]]", ""), ","), lambda x: F.trim(x)))), ",")


def clean_shrub(c: Column) -> Column:
    return F.when(F.lower(c).contains("shrub"), "shrub").otherwise(c)


def habit_to_pft(habit: Column, leaf: Column, source: str = "ava") -> Column:
    """Plant functional type by the rules of a source: the first with a word in the habit, else the habit in lower case.

    A shrub or tree without leaf retention is null.
    """
    low = F.lower(habit)
    out = F.when(habit.isNull(), F.lit(None).cast("string"))
    for pft, marks in HABIT_RULES[source]:
        found = low.contains(marks[0])
        for m in marks[1:]:
            found = found | low.contains(m)
        out = out.when(found, F.concat(leaf, F.lit(pft.removeprefix("{leaf}"))) if pft.startswith("{leaf}") else F.lit(pft))
    return out.otherwise(low)


def replaced(c: Column, names: dict[str, str]) -> Column:
    """Whole values by their replacement; others stay."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c), c)


def override_rank(name: Column, rank: Column) -> Column:
    """The rank of the listed names, else the given one."""
    listed = F.try_element_at(F.create_map(*(F.lit(x) for pair in RANK_OVERRIDES.items() for x in pair)), name)
    return F.coalesce(listed, rank)


def tidy_subsource(c: Column) -> Column:
    """Underscores to spaces, without text in brackets, trimmed, by its published name."""
    return replaced(F.trim(F.regexp_replace(F.replace(c, F.lit("_"), F.lit(" ")), r"\([^)]*\)", "")), SUBSOURCES)


def subsource_of_site(c: Column) -> Column:
    """By the first of the listed parts that the site's code contains; else null."""
    out = F.lit(None).cast("string")
    for part, name in reversed(SUBSOURCES_OF_SITES.items()):
        out = F.when(c.contains(part), name).otherwise(out)
    return out


def composed_id(*parts: Column) -> Column:
    """`a.b`; null parts are left out."""
    return F.concat_ws(".", *(p.cast("string") for p in parts))


def swapped_id(c: Column) -> Column:
    """`a_b_c` of numbers becomes `a.c.b`."""
    return F.regexp_replace(c, r"(\d+)_(\d+)_(\d+)", "$1.$3.$2")


def group_id(group: Column, year: Column, source: Column, prefix: str = "") -> Column:
    """`group_year_source`, with a prefix."""
    return F.concat(F.lit(prefix), F.concat_ws("_", group.cast("string"), year.cast("string"), source))


def first_name(*names: Column) -> Column:
    """The first of several name columns that holds one."""
    return F.coalesce(*names)


def hash_id(c: Column, letter: str = "u") -> Column:
    """A letter and nine hex digits of SHA-1; missing or infinite gives `<letter>missing`."""
    bad = c.isNull() | F.lower(c.cast("string")).isin("inf", "-inf", "infinity", "-infinity", "nan")
    return F.when(bad, f"{letter}missing").otherwise(F.concat(F.lit(letter), F.substring(F.sha1(c.cast("string").cast("binary")), 1, 9)))


def list_text(c: Column) -> Column:
    """Array from `[...]`, `(...)` or comma text; null gives an empty array."""
    bare = F.regexp_replace(c, "^\\s*[\\[(]|[\\])]\\s*$", "")
    parts = F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(F.regexp_replace(x, "^\\s*['\"]|['\"]\\s*$", ""))), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def title_label(c: Column) -> Column:
    return F.initcap(F.replace(F.replace(c, F.lit("_cover"), F.lit("")), F.lit("_"), F.lit(" ")))


def name_before_digits(c: Column) -> Column:
    """Leading `_` parts of a file name, up to the first that starts with a digit."""
    return F.regexp_extract(c, "^(.*?)_[0-9]", 1)
