"""Quality rules with distribution divergence (operator 9), DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated three-word
windows of a text.  The method compares two histograms of the text, its
character classes and its common words, to references of each language by
Jensen-Shannon distance; a text is rejected if it is farther from every
language than chance explains at its length.  Texts under ``min_words`` are
too short to compare.

The references are sums over all documents of the given languages with at
least ``min_words`` words, so they follow the corpus; they have a fixed size
(languages x bins) and are summed with partial aggregation.  Text is never
shuffled: rows are counted and judged in place.

Null and empty texts have no words and fail the base rules; very long texts are
judged whole; an empty table gives no rows.  Only id, text and lang are read,
so other columns can have any name but those that begin with ``_ll_``.  Rows
are judged one by one, so repeated rows and null ids get the same verdict each;
a distance equal to its limit is kept.  Rows of
an unlisted or null language add to no reference but are compared like any.
Without any reference (no long enough row of a listed language) only the
base rules count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, materialize

#: The most frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that it for on".split(),
    "fr": "de la le et les des en un que qui".split(),
    "de": "der die und das in den von zu mit ist".split(),
    "es": "de la que el en los se del las por".split(),
}
CLASSES = ("lower", "upper", "digit", "white", "punctuation", "other_script")


@dataclass(frozen=True)
class Rules:
    """A histogram of n words lies off its own language by chance, by about 1 / sqrt(n).

    So a distance's limit is a floor plus noise / sqrt(n), from ``min_words`` on.
    """

    min_words: int = 50              # base rule, and guard of both histograms
    max_repeat_percent: int = 50     # base rule
    class_floor: float = 0.12
    class_noise: float = 1.1
    word_floor: float = 0.23
    word_noise: float = 0.65
    #: from so many different repeated windows on, sorting marks their places instead of look-ups
    many_repeats: int = 64
    common_words: tuple = tuple((lang, tuple(words)) for lang, words in COMMON_WORDS.items())

    def vocabulary(self) -> list[str]:
        return list(dict.fromkeys(w for _, words in self.common_words for w in words))

    def languages(self) -> list[str]:
        return [lang for lang, _ in self.common_words]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _matched(text: Column, pattern: str) -> Column:
    """Code points in matches of ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeat_words(words: Column, many: int = 64) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash.  Sorting brings equal hashes side by
    side; texts with a few repeated windows then look their places up, others
    sort (hash, place) pairs.  Either way the work is n log n in the words.
    """
    def of(w: Column) -> Column:
        hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
                         F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        return let(hashes, covered)

    def covered(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(let(F.sort_array(hashes), repeated), lambda d: let(
                F.when(F.size(d) <= many, looked_up(hashes, d)).otherwise(let(pairs(hashes), paired)), spread)))

    def repeated(s: Column) -> Column:
        return F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1)))

    def looked_up(hashes: Column, d: Column) -> Column:
        return F.array_compact(F.transform(hashes, lambda h, i: F.when(F.array_contains(d, h), i)))

    def pairs(hashes: Column) -> Column:
        return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def paired(s: Column) -> Column:
        same = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"]))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def spread(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    return let(words, of)


def class_counts(text: Column, word_chars: Column, rest: Column) -> Column:
    """Code points per class of ``CLASSES``; ``rest`` is the text without a-z and white space."""
    def of(r: Column) -> Column:
        upper, digit, other = _matched(r, "[A-Z]+"), _matched(r, "[0-9]+"), _matched(r, r"[^\x00-\x7F]+")
        return F.array(word_chars - F.length(r), upper, digit, F.length(text) - word_chars,
                       F.length(r) - upper - digit - other, other)
    return let(rest, of)


def word_counts(words: Column, rules: Rules) -> Column:
    """Occurrences of each vocabulary word (lower or capitalised), then of all other words."""
    vocabulary = rules.vocabulary()
    forms = list(dict.fromkeys([*vocabulary, *(w.capitalize() for w in vocabulary)]))

    def count(common: Column) -> Column:
        each = [F.size(common) - F.size(F.array_remove(common, w)) for w in vocabulary]
        return F.array(*each, F.size(words) - F.size(common))

    return let(F.transform(F.filter(words, lambda w: w.isin(forms)), F.lower), count)


def histograms(docs: DataFrame, rules: Rules, text_col: str, **more: Column) -> DataFrame:
    """``more`` plus _ll_text, _ll_words, _ll_n, _ll_chars (in words), _ll_rest, _ll_c and _ll_v (histograms)."""
    df = docs.select(*[c.alias(k) for k, c in more.items()],
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_ll_text"))
    t, w = F.col("_ll_text"), F.col("_ll_words")
    df = df.withColumn("_ll_words", words_of(t))
    df = df.withColumns({"_ll_n": F.size(w).cast("long"), "_ll_chars": F.length(F.array_join(w, "")),
                         "_ll_rest": F.regexp_replace(t, r"[a-z\x20\x09-\x0D]+", "")})
    return df.withColumns({"_ll_c": class_counts(t, F.col("_ll_chars"), F.col("_ll_rest")),
                           "_ll_v": word_counts(w, rules)})


def measured(docs: DataFrame, rules: Rules, text_col: str, **more: Column) -> DataFrame:
    """``more`` plus every count of the rules: all that needs the text."""
    df = histograms(docs, rules, text_col, **more)
    t, w, n = F.col("_ll_text"), F.col("_ll_words"), F.col("_ll_n")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    df = df.withColumns({
        "_ll_symbols": F.length(F.regexp_replace("_ll_rest", r"[^#*$%&|<>]+", "")).cast("long"),
        "_ll_dup": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_ll_repeat": repeat_words(w, rules.many_repeats).cast("long")})
    df = df.withColumn("_ll_failed", (n < rules.min_words) | (100 * F.col("_ll_repeat") > rules.max_repeat_percent * n))
    return df.select(*more, n, F.col("_ll_chars").cast("long").alias("_ll_chars"), "_ll_symbols", "_ll_dup",
                     "_ll_repeat", "_ll_failed", "_ll_c", "_ll_v")


def references(counted: DataFrame, rules: Rules) -> dict:
    """Histogram sums per language (column _ll_lang) over all its long enough rows: one small row a language."""
    bins = len(rules.vocabulary()) + 1
    rows = counted.where(F.col("_ll_lang").isin(rules.languages()) & (F.col("_ll_n") >= rules.min_words))
    sums = [F.sum(F.get("_ll_c", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.get("_ll_v", F.lit(i))).alias(f"v{i}") for i in range(bins)]
    return {r["_ll_lang"]: ([r[f"c{i}"] for i in range(len(CLASSES))], [r[f"v{i}"] for i in range(bins)])
            for r in rows.groupBy("_ll_lang").agg(*sums).collect()}


def distance(counts: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) between a histogram of counts and reference counts."""
    total = sum(reference) or 1
    q = F.array(*[F.lit(n / total) for n in reference])

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def divergence(n: Column) -> Column:
        shares = F.transform(counts, lambda c: c / n)
        terms = F.zip_with(shares, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2

    size = F.aggregate(counts, F.lit(0).cast("double"), lambda s, c: s + c)
    return F.sqrt(F.greatest(F.lit(0.0), let(F.greatest(size, F.lit(1.0)), divergence)))


def verdict(df: DataFrame, found: dict, rules: Rules) -> DataFrame:
    """``measured`` rows plus _ll_dc, _ll_dw (distances to the nearest reference) and _ll_kept."""
    def nearest(counts: Column, refs: list) -> Column:
        return F.when(~F.col("_ll_failed"), let(counts, lambda x: F.least(*[distance(x, r) for r in refs], F.lit(1.0))))

    if not found:
        return df.withColumns({"_ll_dc": F.lit(None).cast("double"), "_ll_dw": F.lit(None).cast("double"),
                               "_ll_kept": ~F.col("_ll_failed")})
    df = df.withColumns({"_ll_dc": nearest(F.col("_ll_c"), [r[0] for r in found.values()]),
                         "_ll_dw": nearest(F.col("_ll_v"), [r[1] for r in found.values()])})
    chance = F.sqrt(F.greatest(F.col("_ll_n"), F.lit(1)))
    near = (F.col("_ll_dc") <= rules.class_floor + rules.class_noise / chance) & (
        F.col("_ll_dw") <= rules.word_floor + rules.word_noise / chance)
    return df.withColumn("_ll_kept", ~F.col("_ll_failed") & F.coalesce(near, F.lit(False)))


def judge(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its counts, base_failed, kept, class_distance, word_distance.

    The counts (some numbers a row) are written once; references and verdicts read them.
    """
    counted = materialize(measured(docs, rules, text_col, _ll_id=F.col(f"`{id_col}`"), _ll_lang=F.col(f"`{lang_col}`")),
                          "quality-counts")
    done = verdict(counted, references(counted, rules), rules)
    names = {"_ll_id": "doc_id", "_ll_n": "n_words", "_ll_chars": "word_chars", "_ll_symbols": "n_symbols",
             "_ll_dup": "n_dup_lines", "_ll_repeat": "n_repeat_words", "_ll_failed": "base_failed", "_ll_kept": "kept",
             "_ll_dc": "class_distance", "_ll_dw": "word_distance"}
    return done.select(*[F.col(k).alias(v) for k, v in names.items()])


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged: one pass for the references, one for the verdicts."""
    found = references(histograms(docs, rules, text_col, _ll_lang=F.col(f"`{lang_col}`")), rules)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    done = verdict(measured(docs, rules, text_col, _ll_row=row), found, rules)
    # As a generator, since a filter would be pushed below the counts and evaluate them again and again.
    return done.select(F.inline(F.when(F.col("_ll_kept"), F.array("_ll_row"))))


def op9_quality_rules(docs: DataFrame) -> DataFrame:
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(docs).select("doc_id", *columns)


def op9_sql(rules: Rules = Rules()) -> str:
    """The same rows in DuckDB's SQL."""
    vocabulary, languages = rules.vocabulary(), ", ".join(f"'{x}'" for x in rules.languages())
    each = ", ".join(f"len(list_filter(w, lambda x: x in ('{v}', '{v.capitalize()}')))" for v in vocabulary)
    white = "[\\x20\\x09-\\x0D]"

    def matched(pattern: str) -> str:
        return f"(length(t) - length(regexp_replace(t, '{pattern}', '', 'g')))"

    def sums(name: str, n: int) -> str:
        return "[" + ", ".join(f"sum({name}[{i + 1}])" for i in range(n)) + "]"

    def dist(p: str, q: str) -> str:
        part = "case when {a} > 0 then {a} * log2({a} / (({p}[i] + {q}[i]) / 2)) else 0 end"
        both = " + ".join(part.format(a=f"{x}[i]", p=p, q=q) for x in (p, q))
        return f"sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {both})) / 2))"

    bins = len(vocabulary) + 1
    return f"""
with d as (select row_number() over () as rid, doc_id, lang, coalesce(text, '') as t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
h as (select rid, lang, t, w, len(w) as n, length(regexp_replace(t, '{white}', '', 'g')) as word_chars,
             {matched("[A-Z]")} as upper, {matched("[0-9]")} as digit, {matched(r"[^\x00-\x7F]")} as other,
             length(regexp_replace(t, '[a-z\\x20\\x09-\\x0D]', '', 'g')) as rest, [{each}] as common from d),
counts as (select rid, lang, n, word_chars,
                  [word_chars - rest, upper, digit, length(t) - word_chars, rest - upper - digit - other, other] as c,
                  list_append(common, n - list_sum(common)) as v from h),
refs as (select {sums("c", len(CLASSES))} as c, {sums("v", bins)} as v from counts
         where lang in ({languages}) and n >= {rules.min_words} group by lang),
q as (select list_transform(c, lambda x: x / greatest(list_sum(c), 1)) as c,
             list_transform(v, lambda x: x / greatest(list_sum(v), 1)) as v from refs),
p as (select rid, n, list_transform(c, lambda x: x / greatest(list_sum(c), 1)) as c,
             list_transform(v, lambda x: x / greatest(list_sum(v), 1)) as v from counts where n >= {rules.min_words}),
near as (select rid, min({dist("p.c", "q.c")}) as dc, min({dist("p.v", "q.v")}) as dw from p, q group by rid),
windows as (select rid, w[i] as a, w[i + 1] as b, w[i + 2] as c, i
            from (select rid, w, unnest(range(1, len(w) - 1)) as i from d)),
again as (select rid, i from (select rid, i, count(*) over (partition by rid, a, b, c) as k from windows) where k > 1),
repeats as (select rid, count(distinct j) as n_repeat from (select rid, unnest([i, i + 1, i + 2]) as j from again)
            group by rid),
lines as (select rid, count(*) - count(distinct line) as n_dup
          from (select rid, unnest(string_split(t, chr(10))) as line from d)
          where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid),
base as (select rid, doc_id, len(w) as n_words, t, coalesce(n_repeat, 0) as n_repeat, coalesce(n_dup, 0) as n_dup,
                len(w) < {rules.min_words} or 100 * coalesce(n_repeat, 0) > {rules.max_repeat_percent} * len(w) as failed
         from d left join repeats using (rid) left join lines using (rid))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
       length(regexp_replace(base.t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, n_dup::bigint as n_dup_lines,
       n_repeat::bigint as n_repeat_words, failed as base_failed,
       not failed and coalesce(dc <= {rules.class_floor} + {rules.class_noise} / sqrt(greatest(n_words, 1))
         and dw <= {rules.word_floor} + {rules.word_noise} / sqrt(greatest(n_words, 1)),
         not exists (select 1 from refs)) as kept
from base join counts using (rid) left join near using (rid)
"""
