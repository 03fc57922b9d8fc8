"""Benchmark items found in documents by templates, in DataFrame functions only.

A text is brought to a template: numbers, names and units become typed placeholders. Windows of five
template words are hash-joined between documents and items, and the slots behind the placeholders
must map onto each other consistently, so that a question asked again with other numbers and
names is found and a text that only shares a pattern of placeholders is not. Windows may also agree with
their names as plain words, so that a copy in other letter case is found.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import within_rows
from .common import kept, session

WINDOW = 5
#: Share of an item's distinct windows that a document must hold.
SIMILARITY = 0.8
#: Share of slots that must agree with the commonest mapping of their value.
CONSISTENCY = 0.8
#: Words in a window that are no placeholder; with fewer, the window is looked up at first only if need be.
MIN_WORDS = 3
#: Item windows that are broadcast at most; beyond that the join shuffles.
BROADCAST_WINDOWS = 500_000

#: Placeholder marks: number, unit, name; the mark between the parts of a number; a capitalised word that may be a name.
NUMBER, UNIT, NAME, PART, MAYBE = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
#: White space, all of which counts as one blank.
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

NUMBER_WORDS = """two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
    seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
    dozen""".split()
UNITS = """mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer
    kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ounce ounces pound pounds ton tons
    ml cl l liter liters litre litres gallon gallons pint pints quart quarts cup cups s sec secs second seconds min mins
    minute minutes h hr hrs hour hours day days week weeks month months year years decade decades mph kmh kph hz khz
    mhz ghz v kv w kw mw j kj kcal cal n pa kpa bar psi c f k percent pct dollar dollars cent cents euro euros usd eur
    gbp yen rupee rupees degree degrees byte bytes kb mb gb tb""".split()


def _any(words: Sequence[str]) -> str:
    """A pattern for any of ``words``, branched on the first letter so that most places fail at once."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        by_first.setdefault(word[0], []).append(re.escape(word[1:]))
    return "(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")"


def marked(text: Column) -> Column:
    """``text`` with every number, unit and name led by its placeholder mark, in lower case.

    A number is a run of digits with inner ``. , : /``, or a number word; a unit is a unit word right
    after a number; a name is a capitalised word inside a sentence. Other capitalised words, as at the
    beginning of a sentence, may be names and have a mark of their own. Numbers and units do not depend on letter
    case, and any white space is one blank. Patterns test the character at hand before they look around it: they run
    over every character of a corpus.
    """
    apart = r"(?![\p{L}\p{N}])"
    marks = NUMBER + UNIT + NAME + PART + MAYBE
    out = F.regexp_replace(F.translate(text, marks + SPACES, " " * len(marks + SPACES)), "  +", " ")
    out = F.regexp_replace(out, r"[.,:/](?=\p{N})(?<=\p{N}.)", PART)
    no_number = rf"(?!{_any([w.capitalize() for w in NUMBER_WORDS])}{apart})"
    capitalised = rf"{no_number}\p{{Lu}}[\p{{Ll}}\p{{M}}]+"
    inside = rf"(?<=[\p{{L}}\p{{N}},;:'’\"”)]\x20){capitalised}"
    out = F.regexp_replace(out, rf"(?=\p{{Lu}}){inside}{apart}", NAME + "$0")
    out = F.lower(F.regexp_replace(out, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}{NAME}]){capitalised}{apart}", MAYBE + "$0"))
    first = "".join(sorted({w[0] for w in NUMBER_WORDS}))
    spelt = rf"(?=[{first}])(?<![\p{{L}}\p{{N}}{NAME}]){_any(NUMBER_WORDS)}{apart}"
    out = F.regexp_replace(out, rf"\p{{N}}[\p{{N}}{PART}]*|{spelt}", f" {NUMBER}$0 ")
    return F.regexp_replace(out, rf"({NUMBER}[\p{{L}}\p{{N}}{PART}]+ [ -]?)[{NAME}{MAYBE}]?({_any(UNITS)}){apart}", f"$1{UNIT}$2")


def tokens(marked_text: Column) -> Column:
    """Words and marked values of a text from ``marked``; all else separates them."""
    return F.array_remove(F.split(marked_text, rf"[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{MAYBE}]+"), "")


#: A token's code: its kind (a place in MARKS, 0 for a word) above the hash of its value.
MARKS = NUMBER + UNIT + NAME + PART + MAYBE
IS_NUMBER, IS_UNIT, IS_NAME, MAY_BE_NAME = (MARKS.index(m) + 1 for m in (NUMBER, UNIT, NAME, MAYBE))
KIND_BITS = 61
VALUE = (1 << KIND_BITS) - 1


def bare(token: Column) -> Column:
    """A token without its mark."""
    return F.translate(token, NUMBER + UNIT + NAME + MAYBE, "")


def code(token: Column) -> Column:
    """Kind and value of a token in one long, so that a window is compared by five longs and no text."""
    kind = F.instr(F.lit(MARKS), F.substring(token, 1, 1))
    value = F.xxhash64(F.when(kind > 0, F.substring(token, 2, 1 << 30)).otherwise(token))
    return F.shiftleft(kind.cast("long"), KIND_BITS).bitwiseOR(value.bitwiseAND(F.lit(VALUE)))


def _any_of(tests: Sequence[Column]) -> Column:
    return reduce(or_, tests)


def _window_keys(codes: Sequence[Column], kinds: Sequence[Column]) -> Column:
    """Hashes of a window: of its template, with names as words, and with all that may be names as slots.

    A window without a word has the hash of its values, and so has one that is without once all
    that may be names are slots: these alone would be found anywhere.
    """
    values = [c.bitwiseAND(F.lit(VALUE)) for c in codes]
    both = list(zip(codes, kinds, values))
    template = F.xxhash64(*[F.when(k.between(IS_NUMBER, IS_NAME), k).otherwise(v) for _, k, v in both])
    nameless = F.xxhash64(*[F.when(k.between(IS_NUMBER, IS_UNIT), k).otherwise(v) for _, k, v in both])
    all_names = F.xxhash64(*[F.when(k == 0, c).otherwise(F.least(k, F.lit(IS_NAME).cast("long"))) for c, k, _ in both])
    same_values = F.xxhash64(F.lit("values"), *values)
    named, maybe = (_any_of([k == kind for k in kinds]) for kind in (IS_NAME, MAY_BE_NAME))
    first = F.when(F.col("n_real") > 0, template).otherwise(same_values)
    slots = F.when(_any_of([k == 0 for k in kinds]), all_names).otherwise(same_values)
    more = F.when(named & maybe, F.array(nameless, slots)).when(named, F.array(nameless)).when(maybe, F.array(slots))
    return F.when(F.col("marks") == 0, F.array(F.xxhash64(*codes))).otherwise(
        F.concat(F.array(first), F.coalesce(more, F.array().cast("array<bigint>")))
    )


def _short_key(codes: Sequence[Column]) -> Column:
    """The hash of a text of fewer words than a window: of its values, as there is too little for a template."""
    return F.xxhash64(F.lit("short"), F.lit(len(codes)), *[c.bitwiseAND(F.lit(VALUE)) for c in codes])


def _window_rows(df: DataFrame, *carry: str, short: Sequence[int] = ()) -> DataFrame:
    """Windows of ``marked`` texts: ``carry..., words, at, n_real, keys``.

    Every token is coded once; windows then are places in the array of codes, so neither words nor
    codes are copied for them. ``n_real`` counts the words that are no placeholder. ``keys`` starts with the
    template's; windows are equal if they share any key. For the lengths in ``short``, keys of as many words from the
    same place on come behind them; near the end of a text these stand alone.
    """
    df = df.select(*carry, tokens(F.col("marked")).alias("words"))
    df = df.select(*carry, "words", F.transform("words", code).alias("codes"))
    least = min([WINDOW, *short])
    places = F.when(F.size("codes") >= least, F.sequence(F.lit(0), F.size("codes") - least))
    # Outer, as otherwise the planner adds a test that the exploded array is not empty, and makes it twice.
    df = df.select(*carry, "words", "codes", F.explode_outer(places).alias("at")).where("at IS NOT NULL")
    codes = [F.col(f"c{k}") for k in range(WINDOW)]
    nothing = F.lit(0).cast("long")
    cut = [F.coalesce(F.get("codes", F.col("at") + k), nothing).alias(f"c{k}") for k in range(WINDOW)]
    df = df.select(*carry, "words", "at", (F.size("codes") - F.col("at")).alias("left"), *cut)
    kinds = [F.col(f"k{k}") for k in range(WINDOW)]
    own_kinds = [F.shiftrightunsigned(c, KIND_BITS).alias(f"k{k}") for k, c in enumerate(codes)]
    df = df.select(*carry, "words", "at", "left", *codes, *own_kinds)
    marks = reduce(lambda a, b: a.bitwiseOR(b), kinds)
    n_real = sum(((~k.between(IS_NUMBER, IS_NAME)).cast("int") for k in kinds), F.lit(0))
    df = df.select(*carry, "words", "at", "left", *codes, *kinds, marks.alias("marks"), n_real.alias("n_real"))
    keys = _window_keys(codes, kinds)
    if short:
        none = F.array().cast("array<bigint>")
        own = [F.when(F.col("left") >= n, F.array(_short_key(codes[:n]))).otherwise(none) for n in short]
        keys = F.concat(F.when(F.col("left") >= WINDOW, keys).otherwise(none), *own)
    return df.select(*carry, "words", "at", "n_real", keys.alias("keys"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, at, key, words, window, n_windows, n_words, probe)``: an item's windows, once per key.

    ``window`` is the key of its template; a window is found if any of its keys is.
    Windows of placeholders alone tell nothing about an item and do not count, unless it has
    no others: these are compared by their values. ``probe`` marks the rarest fifth plus one of the distinct
    windows, those of at least MIN_WORDS words first: a document with SIMILARITY of all of
    them holds at least one of these, so only these are looked up at first.
    An item of fewer words than a window is one window of ``n_words``, compared by its values.
    Rows with a null id or a text without words have no windows. Rows that repeat an id are one item.
    """
    texts = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("item_id"), marked(F.coalesce(F.col(text_col), F.lit(""))).alias("marked")
    )
    rows = _window_rows(texts, "item_id").withColumns({"window": F.col("keys")[0], "n_words": F.lit(WINDOW)})
    rows = rows.withColumn("words", F.expr(f"slice(words, at + 1, {WINDOW})"))
    few = texts.select("item_id", tokens(F.col("marked")).alias("words")).where(F.size("words").between(1, WINDOW - 1))
    few = few.select("item_id", "words", F.transform("words", code).alias("codes"))
    key = F.lit(None).cast("long")
    for n in range(1, WINDOW):
        key = F.when(F.size("words") == n, _short_key([F.col("codes")[k] for k in range(n)])).otherwise(key)
    few = few.select("item_id", "words", F.lit(0).alias("at"), F.lit(0).alias("n_real"), F.array(key).alias("keys"))
    rows = rows.unionByName(few.withColumns({"window": F.col("keys")[0], "n_words": F.size("words")}))
    rows = rows.withColumn("most", F.expr("max(n_real) OVER (PARTITION BY item_id)")).where("n_real > 0 OR most = 0").drop("most")
    keys = rows.groupBy("item_id", "window").agg((F.min("n_real") < MIN_WORDS).alias("few"))
    common = keys.groupBy("window").agg(F.count("*").alias("items"))
    sizes = keys.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    ranked = keys.join(common, "window").join(sizes, "item_id")
    ranked = ranked.withColumn("rank", F.expr("row_number() OVER (PARTITION BY item_id ORDER BY few, items, window)"))
    spare = F.col("n_windows") - F.ceil(F.col("n_windows") * SIMILARITY) + 1
    ranked = ranked.select("item_id", "window", "n_windows", (F.col("rank") <= spare).alias("probe"))
    each = rows.select("item_id", "at", "window", "words", "n_words", F.explode_outer("keys").alias("key"))
    return each.join(ranked, ["item_id", "window"])


def _small(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is broadcast, where its number of rows allows."""
    return F.broadcast(df) if within_rows(df, BROADCAST_WINDOWS) else df


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold an item: ``doc_id, text_key, item_id, n_windows, n_found, similarity, n_slots, n_changed, consistency``.

    A row means: at least SIMILARITY of the item's distinct windows occur in the document, and of
    the slots in them at least CONSISTENCY follow the commonest mapping from the item's value to
    the document's. ``n_changed`` counts slots whose value differs: 0 for a verbatim copy.

    Nulls: a null text is empty and holds nothing; a null id stays null; null item ids are
    left out. Repeated documents give one row per item, as do equal ids with equal texts. Empty tables give no rows. Items
    shorter than a window are found by their words in a row, with the same values. Other columns
    are ignored. Texts are read whole; the windows of a very long one are rows of their own.
    """
    spark = session(docs.sparkSession)
    wanted = kept(item_windows(items, item_id_col, item_text_col), "item-windows")
    short = sorted(r[0] for r in wanted.where(F.col("n_words") < WINDOW).select("n_words").distinct().collect())
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    marking = marked(F.col("text")).alias("marked")
    # First look: any of an item's rarest windows.
    found = _window_rows(own.select("doc_id", "text_key", marking), "doc_id", "text_key", short=short)
    found = found.select("doc_id", "text_key", F.explode_outer("keys").alias("key"))
    probes = _small(wanted.where("probe").select("key", "item_id").distinct())
    pairs = kept(found.join(probes, "key").select("doc_id", "text_key", "item_id").distinct(), "item-candidates")
    # Second look, at these documents only: all windows, with places and values. Windows meet by key; of the
    # items that share one, the candidates of the document stay.
    named = pairs.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "item_id")
    some = own.join(
        named.select("id_", "key_").distinct(), own["doc_id"].eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_")), "left_semi"
    )
    some = some.select("doc_id", "text_key", marking)
    rows = _window_rows(some, "doc_id", "text_key", short=short)
    rows = rows.select("doc_id", "text_key", F.expr(f"slice(words, at + 1, {WINDOW})").alias("own_words"), F.explode_outer("keys").alias("key"))
    hits = rows.join(_small(wanted.drop("probe")), "key")
    same = hits["doc_id"].eqNullSafe(named["id_"]) & (hits["text_key"] == named["key_"]) & (hits["item_id"] == named["item_id"])
    hits = kept(hits.join(named, same, "left_semi"), "item-hits")
    place = ["doc_id", "text_key", "item_id"]
    counted = hits.groupBy(*place).agg(F.count_distinct("window").alias("n_found"), F.max("n_windows").alias("n_windows"))
    counted = counted.where(F.col("n_found") >= SIMILARITY * F.col("n_windows"))

    slots = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda k: F.struct((F.col("at") + k).alias("place"), F.get("words", k).alias("item"), F.get("own_words", k).alias("doc")),
    )
    slots = F.filter(slots, lambda s: F.substring(s["item"], 1, 1).isin(NUMBER, UNIT, NAME, MAYBE))
    filled = hits.select(*place, F.explode(slots).alias("s"))
    # The same value with and without a mark, as in a copy in lower case, is no change.
    sure = (F.substring("s.item", 1, 1) != MAYBE).alias("sure")
    filled = filled.select(*place, "s.place", bare(F.col("s.item")).alias("item"), bare(F.col("s.doc")).alias("doc"), sure).distinct()
    mapped = filled.groupBy(*place, "item", "doc").agg(F.count("*").alias("n"))
    # A place that several windows of the document fill differently counts through its best filling.
    best = F.max_by(F.col("item") != F.col("doc"), F.struct("n", F.col("item") == F.col("doc"), "doc"))
    by_value = mapped.groupBy(*place, "item").agg(F.max("n").alias("agree"), best.alias("changed"))
    sizes = filled.groupBy(*place, "item").agg(F.count_distinct("place").alias("n_places"), F.max("sure").alias("sure"))
    judged = (
        by_value.join(sizes, (_on(by_value, sizes, place)) & (by_value["item"] == sizes["item"]))
        .where(F.col("sure") | F.col("changed"))  # a capitalised word that stayed as it was is no slot
        .select(*[by_value[c] for c in place], "agree", "changed", "n_places")
        .groupBy(*place)
        .agg(
            F.sum("n_places").alias("n_slots"),
            F.sum(F.least("agree", "n_places")).alias("n_agree"),
            F.sum(F.when(F.col("changed"), F.col("n_places")).otherwise(0)).alias("n_changed"),
        )
    )
    out = counted.join(judged, _on(counted, judged, place), "left").select(
        *[counted[c] for c in place],
        "n_windows",
        "n_found",
        (F.col("n_found") / F.col("n_windows")).alias("similarity"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
        F.coalesce(F.col("n_agree") / F.col("n_slots"), F.lit(1.0)).alias("consistency"),
    )
    return out.where(F.col("consistency") >= CONSISTENCY)


def _on(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without documents that hold an item; columns and other rows stay as they are.

    Nulls, repeats and empty tables as in ``contaminated``: a repeated document goes or stays in all its rows.
    """
    bad = kept(contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")).distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col(id_col).alias("own_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("own_key"))
    clean = keyed.join(bad, F.col("own_id").eqNullSafe(F.col("id_")) & (F.col("own_key") == F.col("key_")), "left_anti")
    return clean.select("row.*")
