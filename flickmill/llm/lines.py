"""Line dedup within an edit bound of one word, by a deletion-neighbourhood join; built-in functions only.

A variant of a line is what is left when the word at a place is taken out. Its
hash is the XOR of the hashes of the words left, each with its own place, so all
variants of a line come from two running XORs. Two lines with the same variant at
the same place differ by one word replaced there; a line whose variant is another
line as it stands has one word more. Lines with a common variant at a place are all
within the bound of each other, so each is joined with the earliest of its key
only, and no key's lines are paired or gathered. The words are compared
before a line counts as found.

Two lines within the bound have equal first or last halves, so a line emits the
variants of a half only if another line has its other half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flickmill.llm.scratch import written

#: Lines from NEAR_WORDS on, of which a half has two words, are also compared within the bound.
NEAR_WORDS = 4

#: What a line that shares a half emits: variants of its last half, of its first half, itself.
LAST, FIRST, ITSELF = 1, 2, 4

_BLANKS = "[\\x09\\x0B-\\x0D]"
_NOT_BLANK = "[^\\x09-\\x0D\\x20]"


def line_words(line: Column) -> Column:
    """Words of a line that has no white space but blanks."""
    return F.array_remove(F.split(line, " "), "")


def only_blanks(text: Column) -> Column:
    """The text with its white space within lines replaced by blanks, so that splitting needs no pattern."""
    return F.when(text.rlike(_BLANKS), F.regexp_replace(text, _BLANKS, " ")).otherwise(text)


def text_lines(docs: DataFrame) -> DataFrame:
    """(doc, version, line, words) of each line; version is a hash of the whole text."""
    lines = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version"), F.posexplode(F.split(only_blanks(F.col("text")), "\n")).alias("line", "content"))
    return lines.select("doc", "version", "line", line_words(F.col("content")).alias("words"))


def place() -> Column:
    return F.struct("doc", "version", "line")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line that is not blank: first place, number of words and hashes of its halves.

    Halves are named with the number of words of the longer line of a pair: ``last`` and ``first`` are those of a line
    compared with its equals in length, ``longer_last`` and ``longer_first`` of one compared with lines of a word more.
    """
    n, long = F.col("n"), F.col("n") >= NEAR_WORDS
    half, more = F.floor(n / 2).cast("int"), F.floor((n + 1) / 2).cast("int")
    part = lambda kind, size, at, count: F.when(long, F.xxhash64(F.lit(kind), size, F.slice("words", at, count)))
    made = lines.withColumn("n", F.size("words")).where(n >= 1).select(
        F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), "n", place().alias("at"),
        part(FIRST, n, F.lit(1), half).alias("first_half"), part(LAST, n, half + 1, n - half).alias("last_half"),
        part(FIRST, n + 1, F.lit(1), more).alias("longer_first"), part(LAST, n + 1, more, n - more + 1).alias("longer_last"))
    facts = ["n", "first_half", "last_half", "longer_first", "longer_last"]
    return made.groupBy("h1", "h2").agg(F.min("at").alias("first"), *[F.first(c).alias(c) for c in facts]).select("first", *facts)


def sharing(distinct: DataFrame) -> DataFrame:
    """(doc, line, role): the lines that share a half with another that can be within the bound, and what they emit."""
    kinds = [("first_half", LAST), ("last_half", FIRST), ("longer_first", ITSELF), ("longer_last", ITSELF)]
    halves = distinct.where(F.col("n") >= NEAR_WORDS).select("first.doc", "first.line", F.explode(F.array(
        *[F.struct(F.col(c).alias("half"), F.lit(role).alias("role")) for c, role in kinds])).alias("h")).select("doc", "line", "h.*")
    shared = halves.groupBy("half").agg(F.count("*").alias("lines"), F.min("role").alias("role")).where((F.col("lines") > 1) & (F.col("role") < ITSELF))
    return halves.join(shared.select("half"), "half", "left_semi").groupBy("doc", "line").agg(F.bit_or("role").alias("role"))


def candidate_lines(docs: DataFrame, roles: DataFrame) -> DataFrame:
    """(at, role, words) of these lines; of differing texts under one doc_id, the line of each."""
    wanted = roles.groupBy("doc").agg(F.collect_list(F.struct("line", "role")).alias("wanted"))  # at most the lines of one text
    texts = docs.join(wanted, docs["doc_id"] == wanted["doc"]).select("doc", F.xxhash64("text").alias("version"), "wanted",
                                                                   F.explode(F.array(F.split(only_blanks(F.col("text")), "\n"))).alias("lines"))
    each = texts.select("doc", "version", F.explode(F.transform("wanted", lambda x: F.struct(
        x["line"].alias("line"), x["role"].alias("role"), F.get("lines", x["line"]).alias("content")))).alias("x")).select("doc", "version", "x.*")
    return each.where("content is not null").select(place().alias("at"), "role", line_words(F.col("content")).alias("words")).where(
        F.size("words") >= NEAR_WORDS).dropDuplicates(["at"])  # a document row can stand more than once


def variants(candidates: DataFrame) -> DataFrame:
    """(left, place, hash, first): the candidates' deletion variants, and with place -1 those that stand for themselves."""
    each = candidates.select(F.col("at").alias("first"), "role", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    each = each.select("first", "role", "n", "i", F.xxhash64("i", "word").alias("f"), F.xxhash64(F.col("i") - 1, "word").alias("g"))
    whole = Window.partitionBy("first").orderBy("i")
    running = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("first")
    sums = each.select("first", "role", "n", "i", "f", F.bit_xor("f").over(running).alias("fs"), F.bit_xor("g").over(running).alias("gs"), F.bit_xor("g").over(whole).alias("gall"))
    half = F.floor(F.col("n") / 2).cast("int")
    emits = F.when(F.col("i") >= half, F.col("role").bitwiseAND(F.lit(LAST))).otherwise(F.col("role").bitwiseAND(F.lit(FIRST))) != 0
    taken = F.when(emits, F.struct((F.col("n") - 1).alias("left"), F.col("i").alias("place"),
                                   F.col("fs").bitwiseXOR(F.col("f")).bitwiseXOR(F.col("gall")).bitwiseXOR(F.col("gs")).alias("hash")))
    itself = F.when((F.col("i") == F.col("n") - 1) & (F.col("role").bitwiseAND(F.lit(ITSELF)) != 0),
                    F.struct(F.col("n").alias("left"), F.lit(-1).alias("place"), F.col("fs").alias("hash")))
    return sums.select("first", F.explode(F.array(taken, itself)).alias("v")).where("v is not null").select("first", "v.*").distinct()


def within_one_word(a: Column, b: Column, at: Column) -> Column:
    """Whether two word lists are equal but for one word replaced, added or left out at this place."""
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    extra = F.size(longer) - F.size(shorter)
    rest = F.slice(shorter, at + 1 + F.when(extra == 0, 1).otherwise(0), F.size(shorter) + 1)
    return (extra <= 1) & (F.slice(longer, F.lit(1), at) == F.slice(shorter, F.lit(1), at)) & (F.slice(longer, at + 2, F.size(longer) + 1) == rest)


def near_lines(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(first): first places of the distinct lines that have an earlier line within the bound."""
    candidates = written(candidate_lines(docs, sharing(distinct)), "line_candidates")
    keys = written(variants(candidates), "line_variants")
    replaced = keys.where("place >= 0").groupBy("left", "place", "hash").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low < high")
    same = keys.join(replaced.select("left", "place", "hash", "low"), ["left", "place", "hash"]).select("first", "low", "place")
    # the lines of one word more whose variant a line is: each meets that line, and it the earliest of them
    longer = F.when(F.col("place") >= 0, F.struct("first", "place"))
    met = keys.groupBy("left", "hash").agg(F.min(F.when(F.col("place") < 0, F.col("first"))).alias("shorter"), F.min(longer).alias("longer"))
    met = keys.join(met.where("shorter is not null and longer is not null"), ["left", "hash"])
    own = F.col("place") < 0
    other = met.select("first", F.when(own, F.col("longer.first")).otherwise(F.col("shorter")).alias("low"), F.when(own, F.col("longer.place")).otherwise(F.col("place")).alias("place"))
    found = written(same.unionByName(other).where("low < first").groupBy("first", "low").agg(F.min("place").alias("place")), "line_found")
    words = candidates.join(found.select(F.col("first").alias("at")).union(found.select("low")).distinct(), "at", "left_semi")
    mine, lower = (words.select(F.col("at").alias(a), F.col("words").alias(w)) for a, w in (("first", "own"), ("low", "other")))
    sure = found.join(mine, "first").join(lower, "low").where(within_one_word(F.col("own"), F.col("other"), F.col("place")))
    return sure.select("first").distinct()


def judged(docs: DataFrame) -> DataFrame:
    """The document rows with all their columns and, after them, ``line_facts``: a struct of n_lines, n_removed and
    text, the lines that stay (null for null text).

    Lines end at \\n, words are runs of other than ASCII white space. A line that is not blank goes if an earlier
    line (by doc_id, then place in the text) has the same words, or, for two lines of NEAR_WORDS or more
    each, the same but for one word replaced, added or left out. Lines are judged on the input, so a line also goes
    where the earlier one goes itself. Blank lines stay. Rows with a null doc_id are compared with none
    and keep all lines; repeated rows of one doc_id and text are judged alike; of differing texts under one doc_id,
    that with the lesser hash counts as earlier. An input column named line_facts is replaced.
    """
    docs = docs.drop("line_facts")
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    distinct = written(distinct_lines(text_lines(known)), "line_classes")
    near = near_lines(distinct, known)
    stays = distinct.select("first").join(near, "first", "left_anti").select("first.*")
    stays = stays.groupBy("doc", "version").agg(F.collect_list("line").alias("__kept"))  # at most the lines of one text
    named = [F.col(f"d.`{c}`") for c in docs.columns]
    both = docs.alias("d").join(stays.alias("s"), (F.col("d.doc_id") == F.col("s.doc")) & (F.xxhash64("d.text") == F.col("s.version")), "left")
    # split once: a generator's column is not computed again inside the functions below
    both = both.select(*named, F.col("s.__kept").alias("__kept"), F.explode(F.array(F.split(F.col("d.text"), "\n"))).alias("__lines"))
    blank = F.filter(F.transform("__lines", lambda x, i: F.when(~x.rlike(_NOT_BLANK), i)), lambda i: i.isNotNull())
    kept = F.array_sort(F.concat(F.coalesce("__kept", F.array().cast("array<int>")), blank))
    made = both.withColumn("__left", F.when(F.col("doc_id").isNull(), F.col("__lines")).otherwise(F.transform(kept, lambda i: F.get("__lines", i))))
    count = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    facts = F.struct(count("__lines").alias("n_lines"), (count("__lines") - count("__left")).alias("n_removed"), F.array_join("__left", "\n").alias("text"))
    return made.withColumn("line_facts", facts).drop("__kept", "__lines", "__left")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_removed, text (see ``judged``)."""
    return judged(docs).select("doc_id", "line_facts.n_lines", "line_facts.n_removed", "line_facts.text")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents with their columns as they are, without the lines that go; a column n_chars follows the new
    text. Documents of which no word is left although lines went are dropped."""
    out = judged(docs)
    gone = (F.col("line_facts.n_removed") > 0) & (~F.col("line_facts.text").rlike(_NOT_BLANK))
    put = {"text": F.col("line_facts.text")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("line_facts.n_removed") > 0, F.length("line_facts.text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.where(~F.coalesce(gone, F.lit(False))).select(*[put[c].alias(c) if c in put else F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i AS line, ls[i] AS content, list_filter(regexp_split_to_array(ls[i], '[\x09-\x0D\x20]+'), lambda w: w <> '') AS words
          FROM raw, unnest(range(1, len(ls) + 1)) AS u(i)),
firsts AS (SELECT words, len(words) AS n, min(doc_id * 1000000 + line) AS pos FROM lines WHERE len(words) >= 1 GROUP BY words),
keyed AS (SELECT pos, n - 1 AS l, p, list_concat(words[1:p - 1], words[p + 1:]) AS v FROM firsts, unnest(range(1, n + 1)) AS u(p) WHERE n >= 4
          UNION ALL SELECT pos, n, p, words FROM firsts, unnest(range(1, n + 2)) AS u(p) WHERE n >= 4),
lows AS (SELECT l, p, hash(v) AS h, min(pos) AS low FROM keyed GROUP BY l, p, hash(v)),
near AS (SELECT DISTINCT pos FROM keyed JOIN lows ON keyed.l = lows.l AND keyed.p = lows.p AND hash(keyed.v) = lows.h WHERE low < pos),
stay AS (SELECT pos FROM firsts WHERE pos NOT IN (SELECT pos FROM near)),
judged AS (SELECT lines.*, len(words) < 1 OR stay.pos IS NOT NULL AS stays FROM lines LEFT JOIN stay ON doc_id * 1000000 + line = stay.pos),
made AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
                coalesce(string_agg(content, chr(10) ORDER BY line) FILTER (stays), '') AS text FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, made.text AS text FROM documents d LEFT JOIN made ON d.doc_id = made.doc_id
"""
