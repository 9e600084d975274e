"""Stemming as column expressions: rule tables turned into CASE and regexp_replace.

The whole stemmer runs in the JVM, so it needs neither a Python worker nor a
vocabulary join. A rule holds a suffix, its replacement and a condition on the
rest of the word; the first suffix of a step that fits decides the step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: suffix-stripping rules of Porter (1980) with the usual extensions ---

CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
MEASURE_ABOVE_0 = f"(?:{CONSONANTS})?{VOWELS}{CONSONANTS}"
MEASURE_ABOVE_1 = f"{MEASURE_ABOVE_0}{VOWELS}{CONSONANTS}"
HAS_VOWEL = f"(?:{CONSONANTS})?[aeiouy]"
MEASURE_1_ONLY = f"^(?:{CONSONANTS})?{VOWELS}{CONSONANTS}(?:{VOWELS})?$"
SHORT_END = f"^(?:{CONSONANTS}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"

STEP_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
          ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
          ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
          ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
          ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful")]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
          "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
             "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
             "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
             "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}


def _cut(word: Column, n: int) -> Column:
    return word.substr(F.lit(1), F.length(word) - n)


def _replace(word: Column, condition: str, suffix: str, replacement: str) -> Column:
    """Swap the suffix where the rest starts with `condition`, else leave the word."""
    return F.regexp_replace(word, f"^({condition}.*){suffix}$", "$1" + replacement)


def _first_suffix(word: Column, rules: list[tuple[str, Column]]) -> Column:
    """First fitting suffix decides. Rules are grouped by their last letter, so a
    word is compared with the few suffixes it can have."""
    by_letter: dict[str, Column] = {}
    for suffix, result in rules:
        test = word.endswith(suffix)
        chain = by_letter.get(suffix[-1])
        by_letter[suffix[-1]] = F.when(test, result) if chain is None else chain.when(test, result)
    expr = None
    for letter, chain in by_letter.items():
        test, result = word.endswith(letter), chain.otherwise(word)
        expr = F.when(test, result) if expr is None else expr.when(test, result)
    return expr.otherwise(word)


def _plural(w: Column) -> Column:
    return _first_suffix(w, [
        ("sses", _cut(w, 2)),
        ("ies", F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2))),
        ("ss", w), ("s", _cut(w, 1))])


def _participle(w: Column) -> Column:
    """Cut -ed and -ing; a leading ``+`` asks the next step to repair the end."""
    def cut(suffix: str) -> Column:
        rest = _cut(w, len(suffix))
        return F.when(rest.rlike("^" + HAS_VOWEL), F.concat(F.lit("+"), rest)).otherwise(w)
    return _first_suffix(w, [
        ("ied", F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2))),
        ("eed", _replace(w, MEASURE_ABOVE_0, "eed", "ee")),
        ("ed", cut("ed")), ("ing", cut("ing"))])


def _repair(marked: Column) -> Column:
    w = marked.substr(F.lit(2), F.length(marked))
    last, before = F.substring(w, -1, 1), F.substring(w, -2, 1)
    double = (F.length(w) >= 2) & (last == before) & ~last.rlike("[aeiouy]")
    fixed = (F.when(w.endswith("at") | w.endswith("bl") | w.endswith("iz"), F.concat(w, F.lit("e")))
             .when(double, F.when(last.isin("l", "s", "z"), w).otherwise(_cut(w, 1)))
             .when(w.rlike(MEASURE_1_ONLY) & w.rlike(SHORT_END), F.concat(w, F.lit("e")))
             .otherwise(w))
    return F.when(marked.startswith("+"), fixed).otherwise(marked)


def _final_y(w: Column) -> Column:
    """-y becomes -i behind a consonant that is not the first letter. What stands
    before the y is a consonant unless it is aeiou, or a y behind a consonant."""
    return F.when(w.endswith("y") & (w.rlike("^.+[^aeiouy]y$") | w.rlike("^.*[aeiou]yy$")),
                  F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _al_first(w: Column) -> Column:
    return _first_suffix(w, [("alli", _replace(w, MEASURE_ABOVE_0, "alli", "al"))])


def _step_2(w: Column) -> Column:
    rules = [(s, _replace(w, MEASURE_ABOVE_0, s, r)) for s, r in STEP_2]
    logi = F.when(_cut(w, 3).rlike("^" + MEASURE_ABOVE_0), _cut(w, 1)).otherwise(w)
    return _first_suffix(w, [*rules, ("logi", logi)])


def _step_3(w: Column) -> Column:
    return _first_suffix(w, [(s, _replace(w, MEASURE_ABOVE_0, s, r)) for s, r in STEP_3])


def _step_4(w: Column) -> Column:
    def cut(suffix: str) -> Column:
        if suffix == "ion":
            return F.when(_cut(w, 3).rlike("[st]$"), _replace(w, MEASURE_ABOVE_1, "ion", "")).otherwise(w)
        return _replace(w, MEASURE_ABOVE_1, suffix, "")
    return _first_suffix(w, [(s, cut(s)) for s in STEP_4])


def _final_e(w: Column) -> Column:
    rest = _cut(w, 1)
    drop = rest.rlike("^" + MEASURE_ABOVE_1) | (rest.rlike(MEASURE_1_ONLY) & ~rest.rlike(SHORT_END))
    return F.when(w.endswith("e") & drop, rest).otherwise(w)


def _double_l(w: Column) -> Column:
    rest = _cut(w, 1)
    return F.when(w.endswith("ll") & rest.rlike("^" + MEASURE_ABOVE_1), rest).otherwise(w)


def _known(word: Column) -> Column:
    """Irregular and very short words are marked to pass through unchanged."""
    table = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    return F.concat(F.lit("="), F.coalesce(
        table[word], F.when(F.length(word) <= 2, word)))


PORTER_STEPS = [_plural, _participle, _repair, _final_y, _al_first, _step_2, _step_3, _step_4,
                _final_e, _double_l]


def _apply(words: Column, step) -> Column:
    """One step on all words. A transform binds each word once, so the expression
    stays small however often the step mentions it."""
    return F.transform(words, lambda w: F.when(w.startswith("="), w).otherwise(step(w)))


def _porter(words: Column) -> Column:
    marked = F.transform(words, lambda w: F.coalesce(_known(F.lower(w)), F.lower(w)))
    for step in PORTER_STEPS:
        marked = _apply(marked, step)
    return F.transform(marked, lambda w: F.ltrim(w, F.lit("=")))


# --- fixed values: the English stemmer of the Snowball family (Porter 2) ---

EXCEPTIONAL = "gener|commun|arsen"
REGION_1 = f"(?:(?:{EXCEPTIONAL})|(?!{EXCEPTIONAL})[^aeiouy]*[aeiouy]+[^aeiouy])"
REGION_2 = f"{REGION_1}[^aeiouy]*[aeiouy]+[^aeiouy]"
SHORT_SYLLABLE = "(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
ENGLISH_2 = [("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
             ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
             ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
             ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
             ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble")]
ENGLISH_3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
             ("ical", "ic"), ("ness", ""), ("ful", "")]
ENGLISH_4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
             "ive", "ize", "al", "er", "ic"]
ENGLISH_WORDS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
                 "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
                 "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
                 "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
ENGLISH_KEPT = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]


def _mark_y(w: Column) -> Column:
    """A y that starts the word or follows a vowel is a consonant, written Y."""
    return F.regexp_replace(F.regexp_replace(w, "^y", "Y"), "([aeiou])y", "$1Y")


def _possessive(w: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(w, "^'", ""), "('s'|'s|')$", "")


def _english_plural(w: Column) -> Column:
    ies = F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1))
    return _first_suffix(w, [
        ("sses", _cut(w, 2)), ("ied", ies), ("ies", ies), ("us", w), ("ss", w),
        ("s", F.when(w.rlike("[aeiouy].+s$"), _cut(w, 1)).otherwise(w))])


def _kept(w: Column) -> Column:
    return F.when(w.isin(ENGLISH_KEPT), F.concat(F.lit("="), w)).otherwise(w)


def _english_participle(w: Column) -> Column:
    def cut(suffix: str) -> Column:
        rest = _cut(w, len(suffix))
        return F.when(rest.rlike("[aeiouy]"), F.concat(F.lit("+"), rest)).otherwise(w)
    return _first_suffix(w, [
        ("eedly", _replace(w, REGION_1, "eedly", "ee")), ("ingly", cut("ingly")), ("edly", cut("edly")),
        ("eed", _replace(w, REGION_1, "eed", "ee")), ("ing", cut("ing")), ("ed", cut("ed"))])


def _english_repair(marked: Column) -> Column:
    w = marked.substr(F.lit(2), F.length(marked))
    fixed = (F.when(w.rlike("(?:at|bl|iz)$"), F.concat(w, F.lit("e")))
             .when(w.rlike("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _cut(w, 1))
             .when(w.rlike(SHORT_SYLLABLE) & ~w.rlike(f"^{REGION_1}."), F.concat(w, F.lit("e")))
             .otherwise(w))
    return F.when(marked.startswith("+"), fixed).otherwise(marked)


def _english_final_y(w: Column) -> Column:
    return F.when(w.rlike("^.+[^aeiouy][yY]$"), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _english_2(w: Column) -> Column:
    rules = [(s, _replace(w, REGION_1, s, r)) for s, r in ENGLISH_2]
    return _first_suffix(w, [*rules,
                             ("ogi", F.when(w.endswith("logi"), _replace(w, REGION_1, "ogi", "og")).otherwise(w)),
                             ("li", F.when(w.rlike("[cdeghkmnrt]li$"), _replace(w, REGION_1, "li", "")).otherwise(w))])


def _english_3(w: Column) -> Column:
    rules = [(s, _replace(w, REGION_1, s, r)) for s, r in ENGLISH_3]
    return _first_suffix(w, [*rules, ("ative", _replace(w, REGION_2, "ative", ""))])


def _english_4(w: Column) -> Column:
    ion = F.when(w.rlike("[st]ion$"), _replace(w, REGION_2, "ion", "")).otherwise(w)
    return _first_suffix(w, [*[(s, _replace(w, REGION_2, s, "")) for s in ENGLISH_4], ("ion", ion)])


def _english_5(w: Column) -> Column:
    rest = _cut(w, 1)
    drop_e = w.rlike(f"^{REGION_2}.*e$") | (w.rlike(f"^{REGION_1}.*e$") & ~rest.rlike(SHORT_SYLLABLE))
    return (F.when(w.endswith("e") & drop_e, rest)
            .when(w.endswith("ll") & w.rlike(f"^{REGION_2}.*l$"), rest).otherwise(w))


ENGLISH_STEPS = [_possessive, _mark_y, _english_plural, _kept, _english_participle, _english_repair,
                 _english_final_y, _english_2, _english_3, _english_4, _english_5]


def _snowball(words: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ENGLISH_WORDS.items() for x in pair])

    def start(w: Column) -> Column:
        low = F.lower(w)
        known = F.coalesce(table[low], F.when(F.length(low) <= 2, low))
        return F.coalesce(F.concat(F.lit("="), known), low)

    marked = F.transform(words, start)
    for step in ENGLISH_STEPS:
        marked = _apply(marked, step)
    return F.transform(marked, lambda w: F.lower(F.ltrim(w, F.lit("="))))


STEMMERS = {"porter": _porter, "snowball": _snowball}


def stem_array(words: Column | str, algorithm: str = "porter") -> Column:
    """Stem every word of an array."""
    return STEMMERS[algorithm](F.col(words) if isinstance(words, str) else words)


def stem(word: Column | str, algorithm: str = "porter") -> Column:
    """Stem one word."""
    word = F.col(word) if isinstance(word, str) else word
    return F.get(stem_array(F.array(word), algorithm), F.lit(0))


def stem_vocabulary(tokens: DataFrame, column: str = "word", algorithm: str = "porter") -> DataFrame:
    """Distinct words and their stems; each word is stemmed once."""
    return tokens.select(column).distinct().withColumn("stem", stem(column, algorithm))
