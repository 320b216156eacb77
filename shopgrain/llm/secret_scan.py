"""Secret scans by a trigram inverted index, in DataFrame operations only.

From each rule's pattern a Boolean query over trigrams is derived: the pattern's mandatory stretches must all occur (and), a
stretch occurs as one of its spellings (or), a spelling by all its trigrams (and). Texts are folded to lower case for the index, so
that patterns in either case have the same query. The index holds the trigrams that some query asks for: postings (trigram, text key),
where the key is a hash of the text. The postings of a query are intersected by counting, per text and spelling, the trigrams found. Candidates
are then read again and verified with the pattern itself. A rule whose pattern has no mandatory trigram is run on every text.

A rule's matches in a text are those from left to right that do not overlap; ``least`` then drops the ones whose ``group`` is shorter. Offsets
are in code points: a text is cut at its matches, and the lengths of the pieces and matches are added up by a window over the
matches of a text, so that many matches in one text cost no more than a sort. Equal texts are verified as often as they
occur, but their matches are kept once, by sha256, and joined back to all rows.

Rows: a null text is empty, an empty text has no spans. Repeated rows, equal ids and null ids each come out. An empty table gives
no rows. Input columns other than the id and the text are left out, so no name can clash.
"""

from functools import reduce
from itertools import product
from re import IGNORECASE
from re import _parser as patterns  # the standard library's own reading of a pattern
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.operators.lookup import lookup
from shopgrain.sources.scratch import materialise

GRAM = 3
MOST_SPELLINGS = 64  # of one stretch, before it is closed
MOST_CHOICES = 8  # characters of a class that is spelled out


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group that a match must have


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # a match of [0-9a-f]+ is a whole run, so these are its matches of 24 and more
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

Spellings = frozenset[str]
NOTHING: Spellings = frozenset([""])


def _joined(left: Spellings, right: Spellings) -> Spellings:
    return frozenset(a + b for a, b in product(left, right))


def _choices(items: list) -> Spellings | None:
    """The characters of a class, or None if they are many or said by exclusion."""
    found: set[str] = set()
    for op, value in items:
        if op is patterns.LITERAL:
            found.add(chr(value).lower())
        elif op is patterns.RANGE and value[1] - value[0] < MOST_CHOICES:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CHOICES else None


def _pieces(parsed) -> list[Spellings | None]:
    """A pattern as pieces in a row: all spellings of what must stand there, or None where anything may."""
    out: list[Spellings | None] = []
    for op, value in parsed:
        if op is patterns.LITERAL:
            out.append(frozenset([chr(value).lower()]))
        elif op is patterns.IN:
            out.append(_choices(value))
        elif op is patterns.SUBPATTERN:
            out += _pieces(value[3])
        elif op is patterns.BRANCH:
            ways = [_whole(way) for way in value[1]]
            out.append(None if None in ways else frozenset().union(*ways))
        elif op in (patterns.MAX_REPEAT, patterns.MIN_REPEAT):
            least, most, inner = value
            one = _whole(inner)
            if (least, most) == (0, 1):
                out.append(None if one is None else one | NOTHING)
            elif least == 0:
                out.append(None)
            else:
                out += _pieces(inner) * min(least, GRAM)
                out += [] if least == most <= GRAM else [None]
        elif op is not patterns.AT:
            out.append(None)
    return out


def _whole(parsed) -> Spellings | None:
    """All spellings of a pattern, or None if they are not few."""
    found = NOTHING
    for piece in _pieces(parsed):
        if piece is None or len(found) * len(piece) > MOST_SPELLINGS:
            return None
        found = _joined(found, piece)
    return found


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """What a text with a match must hold: all stretches, of each one spelling, of that all trigrams. Empty: nothing is known."""
    stretches, open_ = [], NOTHING
    for piece in [*_pieces(patterns.parse(pattern)), None]:
        if piece is not None and len(open_) * len(piece) <= MOST_SPELLINGS:
            open_ = _joined(open_, piece)
        else:
            stretches.append(open_)
            open_ = NOTHING if piece is None else piece
    stretches.append(open_)
    spelled = [{_trigrams(s) for s in stretch} for stretch in stretches]
    # a spelling without a trigram may stand anywhere, so its stretch asks for nothing; one that asks for more than another adds nothing
    return [
        sorted((w for w in ways if not any(v < w for v in ways)), key=sorted)
        for ways in spelled
        if all(ways)
    ]


def query_terms(rules: list[Rule]) -> list[tuple[str, int, int, int, int, str]]:
    """(kind, stretches of its query, stretch, spelling, trigrams of the spelling, trigram) of every rule with a query."""
    return [
        (rule.kind, len(query), k, w, len(way), gram)
        for rule in rules
        for query in [trigram_query(rule.pattern)]
        for k, ways in enumerate(query)
        for w, way in enumerate(ways)
        for gram in sorted(way)
    ]


TERMS = "kind string, stretches int, stretch int, way int, grams int, gram string"


def grams_in(text: Column, grams: list[str]) -> Column:
    """Which of ``grams`` a folded text holds."""
    held = (F.when(F.contains(text, F.lit(g)), F.lit(g)) for g in grams)
    return F.array_compact(F.array(*held)).cast("array<string>")


def postings(texts: DataFrame) -> DataFrame:
    """gram, key: which trigram occurs in which text (columns key, grams), each pair once."""
    return texts.select("key", F.explode("grams").alias("gram")).distinct()


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """key, kinds: the texts that meet the trigram queries, and of which rules."""
    spark = index.sparkSession
    terms = spark.createDataFrame(query_terms(rules), TERMS)  # as many as the patterns have trigrams
    spelled = (
        index.join(F.broadcast(terms), "gram")
        .groupBy("key", "kind", "stretches", "stretch", "way", "grams")
        .agg(F.count(F.lit(1)).alias("found"))  # postings are distinct
        .where("found = grams")
    )
    return (
        spelled.groupBy("key", "kind", "stretches")
        .agg(F.count_distinct("stretch").alias("found"))
        .where("found = stretches")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))  # rules at most
    )


MATCHES = "array<struct<gap:int,size:int,held:int>>"


def matches(text: Column, rule: Rule) -> Column:
    """The rule's matches from left to right: code points before each since the last one, its own, and its group's."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    held = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    sizes = (F.transform(x, lambda m: F.length(m)) for x in (gaps, found, held))
    return F.arrays_zip(*(s.alias(n) for s, n in zip(sizes, ("gap", "size", "held")))).cast(MATCHES)


def matches_of(text: Column, rules: list[Rule], wanted) -> Column:
    """kind, found: the matches of each rule that ``wanted`` names for the row, where there are any."""
    each = (
        F.when(
            wanted(r) & text.rlike(r.pattern),
            F.struct(F.lit(r.kind).alias("kind"), matches(text, r).alias("found")),
        )
        for r in rules
    )
    return F.array_compact(F.array(*each)).cast(f"array<struct<kind:string,found:{MATCHES}>>")


def spans(
    docs: DataFrame, rules: list[Rule], id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, digest) of all documents, and the spans (digest, kind, begin, stop) of every distinct text.

    The texts are read twice: once for the index and the rules without a query, once to verify the candidates.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(
        F.col(id_column).alias("id"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("key"),
    )
    indexed = [r for r in rules if trigram_query(r.pattern)]
    scanned = [r for r in rules if r not in indexed]
    grams = sorted({t[-1] for t in query_terms(indexed)})
    read = materialise(
        texts.withColumn("folded", F.lower("text")).select(
            "id",
            "digest",
            "key",
            grams_in(F.col("folded"), grams).alias("grams"),
            matches_of(F.col("text"), scanned, lambda r: F.lit(True)).alias("matches"),
        ),
        "trigrams",
    )
    named = lookup(
        texts.select("key", "digest", "text"), candidates(postings(read), indexed), ["key"], "inner"
    )
    verified = named.select(
        "digest",
        matches_of(F.col("text"), indexed, lambda r: F.array_contains("kinds", r.kind)).alias("matches"),
    )
    per_text = (
        read.select("digest", "matches")
        .unionByName(verified)
        .select("digest", F.explode("matches").alias("one"))
        .select("digest", "one.*")
        .dropDuplicates(["digest", "kind"])
    )
    so_far = Window.partitionBy("digest", "kind").orderBy("at")
    placed = (
        per_text.select("digest", "kind", F.posexplode("found").alias("at", "one"))
        .select("digest", "kind", "at", "one.*")
        .withColumn("stop", F.sum(F.col("gap").cast("bigint") + F.col("size")).over(so_far))
    )
    least = reduce(
        lambda rest, r: F.when(F.col("kind") == r.kind, r.least).otherwise(rest), rules, F.lit(0)
    )
    kept = placed.where(F.col("held") >= least).select(
        "digest", "kind", (F.col("stop") - F.col("size")).alias("begin"), "stop"
    )
    return read.select("id", "digest"), kept


def find_secrets(
    docs: DataFrame,
    base: tuple[Rule, ...] = BASE,
    added: tuple[Rule, ...] = ADDED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, spans of each base rule (``n_<kind>``), base_sha256 and spans (``kind:start:end``, by start, then by rule)."""
    rules = [*base, *added]
    rows, found = spans(docs, rules, id_column, text_column)
    order = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind"))
    marked = found.withColumn("order", order)
    is_base = F.col("order") <= len(base)
    entry = F.struct("begin", "order", F.concat_ws(":", "kind", "begin", "stop").alias("said"))

    def joined(entries: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(entries), lambda e: e["said"]), ",")

    per_text = marked.groupBy("digest").agg(
        *(F.count(F.when(F.col("kind") == r.kind, 1)).alias(f"n_{r.kind}") for r in base),
        joined(F.collect_list(F.when(is_base, entry))).alias("base"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    counts = [f"n_{r.kind}" for r in base]
    return lookup(rows, per_text, ["digest"]).select(
        F.col("id").alias(id_column),
        *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
