"""Row-local text expressions over a word table: valence of a text, adjectives, polarity of a list.

A word table of usual size reaches the executors as a one-row subquery, so a text is rated where it
is read: no token leaves its row and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The value of a lower-case word at a position of its text; null if the word table lacks it.
Lookup = Callable[[Column, Column], Column]

# Constants of the published rule-based rating (VADER).
ALPHA = 15.0
BOOST = 0.293
CAPITALS = 0.733
NEGATED = -0.74
BOOST_BY_DISTANCE = (1.0, 0.95, 0.9)
NEVER_SO = 1.25
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
POLAR = 0.05

# Words that negate what follows.
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't",
    "can't", "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt",
    "mightnt", "mustnt", "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't",
    "mustn't", "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't", "shouldn't",
    "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't", "rarely",
    "seldom", "despite",
)

# Words that strengthen, and words that weaken, what follows.
STRONGER = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly",
    "deeply", "effing", "enormous", "enormously", "entirely", "especially", "exceptional",
    "exceptionally", "extreme", "extremely", "fabulously", "flipping", "flippin", "frackin",
    "fracking", "fricking", "frickin", "frigging", "friggin", "fully", "fuckin", "fucking",
    "fuggin", "fugging", "greatly", "hella", "highly", "hugely", "incredible", "incredibly",
    "intensely", "major", "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
WEAKER = (
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of", "less",
    "little", "marginal", "marginally", "occasional", "occasionally", "partly", "scarce",
    "scarcely", "slight", "slightly", "somewhat", "sort of", "sorta", "sortof", "sort-of",
)

# Expressions whose valence is not that of their words.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0,
    "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}

# White space as Python's split() sees it, and ASCII punctuation.
SPACE = r"\t-\r\x1c- \x85\p{Z}"
MARK = r"!-/:-@\[-`{-~"
# A word of more than two signs between marks; its marks are stripped.
MARKED_WORD = rf"(?<![^{SPACE}])[{MARK}]*([^{SPACE}{MARK}][^{SPACE}]+[^{SPACE}{MARK}])[{MARK}]*(?![^{SPACE}])"
# Possessive, as other loops take stack for each part of a chain.
WORD = r"\p{L}++(?:['’-]\p{L}++)*+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``.

    Inside a lambda the optimizer would otherwise repeat the whole expression per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def word_table(words: DataFrame, word: str, value: str) -> DataFrame:
    """Lower-case words ``w`` with one value ``v`` each, the greatest of several."""
    return words.groupBy(F.lower(word).alias("w")).agg(F.max(value).alias("v")).filter("w IS NOT NULL")


def _beginning(word: Column) -> Column:
    return F.substring(word, 1, 3)


def nested_words(table: DataFrame, *keys: str) -> DataFrame:
    """A word table as one row, or one per ``keys``: first letters to a map of the words that begin with them."""
    maps = table.groupBy(*keys, _beginning(F.col("w")).alias("b")).agg(
        F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("words")
    )
    return maps.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("b", "words"))).alias("words"))


def nested_lookup(words: Column) -> Lookup:
    """Look words up in what :func:`nested_words` makes."""
    return lambda w, _position: F.try_element_at(F.try_element_at(words, _beginning(w)), w)


def _split(text: Column) -> Column:
    """Words as the published rating splits them: at white space, marks stripped from longer words."""
    return F.array_remove(F.split(F.regexp_replace(text, MARKED_WORD, "$1"), f"[{SPACE}]+"), "")


def tokens(text: Column) -> Column:
    """The words of a text in lower case."""
    return F.transform(_split(text), F.lower)


def _boost(word: Column) -> Column:
    return F.when(word.isin(*STRONGER), BOOST).when(word.isin(*WEAKER), -BOOST)


def _negates(word: Column) -> Column:
    return word.isin(*NEGATIONS) | F.contains(word, F.lit("n't"))


def _rated(
    text: Column, valences: Column, loud: Column, but: Column, phrases: Column, idioms: Mapping[str, float],
) -> Callable[[Column], Column]:
    """Valence of the word at a position after its capitals, what stands around it, and "but".

    ``text`` has the lists ``words``, in lower case, and ``parts``, as written; ``loud`` says
    whether capitals count, ``phrases`` whether the text has the longest word of any idiom or booster of several
    words, without which it has none of them. Each step goes on from the value of the step before.
    """

    def word(i: Column) -> Column:
        return F.get(text["words"], i)

    def known(i: Column) -> Column:
        return F.get(valences, i).isNotNull()

    def is_in(w: Column, *items: str) -> Column:
        return F.coalesce(w.isin(*items), F.lit(False))

    def capitals(i: Column) -> Column:
        part = F.get(text["parts"], i)
        return F.when(loud & (part != word(i)) & (part == F.upper(part)), CAPITALS).otherwise(0.0)

    def phrase(i: Column, first: int, last: int) -> Column:
        """The words from ``first`` to ``last`` places after the rated one, null if one is lacking."""
        parts = [word(i + k) for k in range(first, last + 1)]
        return F.when(reduce(and_, [p.isNotNull() for p in parts]), F.concat_ws(" ", *parts))

    def alone(i: Column) -> Column:
        """Valence and capitals; "no" is nothing before a rated word, which it turns."""
        v = F.get(valences, i)
        after_no = is_in(word(i - 1), "no") | is_in(word(i - 2), "no") | (
            is_in(word(i - 3), "no") & is_in(word(i - 1), "or", "nor")
        )
        turned = F.when(after_no, v * NEGATED).when(is_in(word(i), "no") & known(i + 1), 0.0).otherwise(v)
        return let(turned, lambda x: x + F.signum(x) * capitals(i))

    def before(i: Column, k: int, value: Column) -> Column:
        """The value after the word ``k`` places before, which does nothing if it is rated itself."""
        prior = word(i - k)
        boost = F.coalesce((_boost(prior) + capitals(i - k)) * BOOST_BY_DISTANCE[k - 1], F.lit(0.0))
        turn = F.when(_negates(prior), NEGATED).otherwise(1.0)
        if k > 1:
            between = [word(i - j) for j in range(1, k)]
            so = reduce(or_, [is_in(w, "so", "this") for w in between])
            doubt = reduce(or_, [is_in(w, "doubt") for w in between])
            turn = F.when((prior == "never") & so, NEVER_SO).when((prior == "without") & doubt, 1.0).otherwise(turn)
        changed = let(value, lambda x: (x + F.signum(x) * boost) * turn)
        if k == 3:
            changed = let(changed, lambda x: F.when(phrases, idiom(i, x)).otherwise(x))
        return F.when(prior.isNotNull() & ~known(i - k), changed).otherwise(value)

    def idiom(i: Column, value: Column) -> Column:
        """Expressions around the word replace its value; two- and three-word boosters before it count."""
        table = F.create_map(*[F.lit(x) for pair in idioms.items() for x in pair]) if idioms else None

        def of(first: int, last: int) -> Column:
            return F.try_element_at(table, phrase(i, first, last)) if idioms else F.lit(None).cast("double")

        behind = F.coalesce(of(-1, 0), of(-2, 0), of(-2, -1), of(-3, -1), of(-3, -2), value)
        whole = F.coalesce(of(0, 2), of(0, 1), behind)
        weaker = [F.when(phrase(i, a, b).isin(*WEAKER), -BOOST).otherwise(0.0) for a, b in ((-3, -1), (-3, -2), (-2, -1))]
        return whole + reduce(lambda x, y: x + y, [F.coalesce(w, F.lit(0.0)) for w in weaker])

    def least(i: Column, value: Column) -> Column:
        turns = is_in(word(i - 1), "least") & ~known(i - 1) & ~is_in(word(i - 2), "at", "very")
        return F.when(turns, value * NEGATED).otherwise(value)

    def rate(i: Column) -> Column:
        weight = F.when(but == 0, 1.0).when(i < but - 1, BEFORE_BUT).when(i > but - 1, AFTER_BUT).otherwise(1.0)
        rated = let(alone(i), lambda x: let(before(i, 1, x), lambda y: let(before(i, 2, y), lambda z: least(i, before(i, 3, z)))))
        silent = _boost(word(i)).isNotNull() | (is_in(word(i), "kind") & is_in(word(i + 1), "of"))
        return F.when(silent, 0.0).otherwise(rated * weight)

    return rate


def _emphasis(text: Column) -> Column:
    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    exclaim = F.least(count("!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION
    ask = F.when(count("?") > MAX_QUESTIONS, MANY_QUESTIONS).when(count("?") > 1, count("?") * QUESTION)
    return exclaim + F.coalesce(ask, F.lit(0.0))


def normalise(total: Column) -> Column:
    """An unbounded sum of valences on the scale -1 to 1, with four decimals."""
    return F.round(total / F.sqrt(total * total + ALPHA), 4)


def compound(text: Column, valence: Lookup, idioms: Mapping[str, float] = IDIOMS) -> Column:
    """Sentiment of a text between -1 and 1; 0 for missing text.

    Rules of the published rating: word valence, strengthening and weakening words and
    negations up to three words before, "no", "least", idioms, capitals, "but", exclamation and
    question marks.
    """

    phrases = [*idioms, *(w for w in WEAKER if " " in w)]
    rarest = sorted({max(phrase.split(), key=len) for phrase in phrases if phrase.split()})

    def total(t: Column, valences: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(valences))
        hits = F.filter(places, lambda i: F.get(valences, i).isNotNull())
        def shouted(p: Column) -> Column:
            return (p == F.upper(p)) & (p != F.lower(p))

        context = F.struct(
            (F.exists(t["parts"], shouted) & F.exists(t["parts"], lambda p: ~shouted(p))).alias("loud"),
            F.coalesce(F.array_position(t["words"], "but"), F.lit(0)).alias("but"),
            F.arrays_overlap(t["words"], F.array(*map(F.lit, rarest))).alias("phrases"),
        )

        def added(c: Column) -> Column:
            rate = _rated(t, valences, c["loud"], c["but"], c["phrases"], idioms)
            return F.aggregate(hits, F.lit(0.0), lambda sum_, i: sum_ + rate(i))

        return F.when(F.exists(valences, lambda x: x.isNotNull()), let(context, added)).otherwise(0.0)

    def of_parts(parts: Column) -> Column:
        both = F.struct(parts.alias("parts"), F.transform(parts, F.lower).alias("words"))
        return let(both, rated)

    def rated(t: Column) -> Column:
        values = F.transform(t["words"], lambda w, i: valence(w, i).cast("double"))
        return let(values, lambda x: total(t, x))

    total_found = F.coalesce(let(_split(text), of_parts), F.lit(0.0))
    return let(
        F.struct(total_found.alias("t"), _emphasis(F.coalesce(text, F.lit(""))).alias("e")),
        lambda s: normalise(s["t"] + F.signum(s["t"]) * s["e"]),
    )


def sentiment(score: Column) -> Column:
    """The label of a compound score."""
    return let(
        score, lambda s: F.when(s >= POLAR, "Positive").when(s <= -POLAR, "Negative").otherwise("Neutral")
    )


def plain_words(text: Column) -> Column:
    """Runs of letters, apostrophes and hyphens inside allowed; none for missing text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def adjectives(text: Column, tag: Lookup) -> Column:
    """Words whose tag starts with ``JJ`` in text order, as a comma list; empty for missing text."""

    def chosen(w: Column, i: Column) -> Column:
        return F.coalesce(tag(F.lower(w), i).startswith("JJ"), F.lit(False))

    return F.array_join(F.filter(plain_words(text), chosen), ",")


def list_words(items: Column) -> Column:
    """Items of a comma list, trimmed and in lower case."""
    return F.transform(
        F.split(items, ",", -1), lambda item: F.lower(F.regexp_replace(item, rf"^[{SPACE}]+|[{SPACE}]+$", ""))
    )


def polarity(items: Column, valence: Lookup) -> Column:
    """Mean polarity of a comma list, null if no item is polar.

    An item counts 1 or -1 from the label thresholds on, its own score in between, and not at
    all if that is 0.
    """

    def one(word: Column, i: Column) -> Column:
        score = normalise(F.when(_boost(word).isNull(), valence(word, i).cast("double")))
        return let(score, lambda s: F.when(s >= POLAR, 1.0).when(s <= -POLAR, -1.0).when(s != 0, s))

    scores = F.filter(F.transform(list_words(items), one), lambda s: s.isNotNull())
    return let(
        scores, lambda s: F.try_divide(F.aggregate(s, F.lit(0.0), lambda a, b: a + b), F.size(s).cast("double"))
    )
