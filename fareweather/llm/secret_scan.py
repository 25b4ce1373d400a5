"""Secret scans: fixed patterns, and strings that a Markov model takes for random.

Two first-order character models are trained from labelled samples, one of random
strings and one of ordinary identifiers. A candidate string is a secret if the log
of the ratio of the likelihoods of any long enough stretch in it reaches a threshold.
Everything is built-in functions: the trained table of log ratios is a scalar subquery of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table, text_or_empty

# The base patterns and the least lengths, by kind.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: The symbols a candidate is made of; any other character is class 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
CLASSES = len(ALPHABET) + 1
#: Symbols of the shortest candidate of the model, and of the shortest stretch of one. A few symbols
#: tell too little: four ordinary letters that the samples happen to lack can reach THRESHOLD.
SHORTEST = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}"
#: Natural log of the least likelihood ratio of a secret. Random strings of 20 symbols
#: reach more than twice this; each ordinary symbol pair takes about two from it.
THRESHOLD = 12.0
#: Labelled documents are taken from at most so many texts, those with the smallest hashes.
SAMPLE_TEXTS = 500
#: Words of a text used for labelled identifiers.
SAMPLE_WORDS = 60
SMOOTHING = 0.1
#: Numbers that are added up at a time, and symbols of a text that are masked at a time.
NUMBERS, SYMBOLS = 128, 4096


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums_before(numbers: Column) -> Column:
    """Per number the sum of those before it. In blocks, as adding to an array copies it: work grows with the
    numbers, not with their square."""
    def added(at, block):
        return F.aggregate(
            block, F.struct(at.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        )["all"]

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda acc, n: acc + n))
        return F.flatten(F.zip_with(blocks, added(F.lit(0), totals), lambda block, at: added(at, block)))

    last = F.greatest(F.floor((F.size(numbers) - 1) / NUMBERS), F.lit(0)).cast("int")
    return _let(numbers, lambda all_: _let(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * NUMBERS + 1, F.lit(NUMBERS))), of_blocks))


def _pieces(text: Column, pattern: str, kind: str, keep) -> Column:
    """Matches of a pattern that ``keep`` accepts, as (start, end, kind) in code points.

    What lies between the matches and the matches themselves add up to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # A match, and how many symbols lie before it after the match before.
    both = F.filter(F.zip_with(found, between, lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"))), lambda x: x["hit"].isNotNull())

    def placed(pairs: Column) -> Column:
        before = _sums_before(F.transform(pairs, lambda x: x["gap"] + F.length(x["hit"])))
        return F.zip_with(pairs, before, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["hit"])).alias("end"), F.lit(kind).alias("kind"), x["hit"].alias("hit"),
        ))

    return F.filter(_let(both, placed), keep)


def _if_any(text: Column, pattern: str, spans: Column) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,kind:string,hit:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns, by start and then in the order assign, access, hex.

    A match of ``assign`` uses up its text even if its value is too short. Runs for
    the other kinds are whole either way, so their least length is part of the pattern.
    """
    value = F.regexp_extract
    assign = _if_any(text, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", _pieces(
        text, ASSIGN, "0assign", lambda s: F.length(value(s["hit"], ASSIGN, 1)) >= LEAST["assign"]))
    access_run = f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"
    access = _if_any(text, access_run, _pieces(text, access_run, "1access", lambda s: F.lit(True)))
    hex_run = f"[0-9a-f]{{{LEAST['hex']},}}"
    hexes = _if_any(text, hex_run, _pieces(text, hex_run, "2hex", lambda s: F.lit(True)))
    return F.array_sort(F.transform(F.concat(assign, access, hexes), lambda s: F.struct(s["start"], s["kind"], s["end"])))


def samples(documents: DataFrame, text: str = "text") -> DataFrame:
    """Labelled strings (sample, label) from a bounded part of the texts.

    Label 0, ordinary: the words of a text that no base pattern touches, in lower and
    upper case and joined as identifiers are. Label 1, random: the values of the
    base patterns, and digests in base 64, in base 16 and in letters and digits.
    """
    hashed = documents.select(text_or_empty(F.col(text)).alias("t")).select("t", F.xxhash64("t").alias("h"))
    # Equal texts count once, so that copies can't fill the sample.
    least = hashed.groupBy("h").agg(F.count("*").alias("n")).orderBy("h").limit(SAMPLE_TEXTS).select("h")
    chosen = cut(hashed.join(F.broadcast(least), "h").dropDuplicates(["h"]))
    words = F.filter(
        F.slice(F.regexp_extract_all(F.regexp_replace("t", ASSIGN, " "), F.lit(r"(?<![^\s])([A-Za-z0-9_/-]{2,19})(?![^\s.,;:!?])"), F.lit(1)), 1, SAMPLE_WORDS),
        lambda w: ~w.rlike(r"^[0-9a-f]+$|^AKIA"),
    )
    some = chosen.select(words.alias("w"), F.sha2("t", 256).alias("d"), F.transform(base_spans(F.col("t")), lambda s: F.substr(F.col("t"), s["start"] + 1, s["end"] - s["start"])).alias("b"))
    pair = F.zip_with("w", F.slice(F.col("w"), 2, SAMPLE_WORDS), lambda a, b: F.struct(a.alias("a"), F.coalesce(b, F.lit("x")).alias("b")))
    ordinary = F.concat(
        F.transform(pair, lambda p: F.concat_ws("_", p["a"], p["b"])),
        F.transform(pair, lambda p: F.concat(F.lower(p["a"]), F.initcap(p["b"]))),
        F.transform(pair, lambda p: F.concat_ws("-", F.lower(p["a"]), F.lower(p["b"]))),
        F.transform(pair, lambda p: F.concat_ws("/", F.lower(p["a"]), F.lower(p["b"]))),
        F.transform(pair, lambda p: F.concat_ws("_", F.upper(p["a"]), F.upper(p["b"]))),
        F.transform(pair, lambda p: F.concat(F.lower(p["a"]), F.lower(p["b"]))),
        F.transform(pair, lambda p: F.concat(F.upper(p["a"]), F.upper(p["b"]))),
    )
    code = F.base64(F.unhex("d"))
    random = F.concat(
        F.transform("b", lambda s: F.regexp_replace(s, r"^.*[\x20:=\"']+", "")),
        F.array(code, F.regexp_replace(code, "[^A-Za-z0-9]", ""), F.upper(F.regexp_replace(code, "[^A-Za-z0-9]", "")), F.col("d"),
                F.translate(code, "+/", "-_")),
    )
    return some.select(F.explode(ordinary).alias("sample"), F.lit(0).alias("label")).unionAll(
        some.select(F.explode(random).alias("sample"), F.lit(1).alias("label"))
    )


def _classes(symbols: Column) -> Column:
    return F.transform(F.split(symbols, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))


def train(labelled: DataFrame) -> DataFrame:
    """One row ``ratios``: for each pair of symbol classes, log P(second | first) if random
    less the same if ordinary, in natural logs, smoothed; pair (a, b) at a * CLASSES + b.

    ``labelled`` has ``sample`` and ``label`` (1 random, 0 ordinary). Null and empty samples
    teach nothing; without any sample all ratios are 0 and nothing is found.
    """
    pairs = labelled.where("sample is not null and label is not null").select("label", _classes(F.col("sample")).alias("c")).select(
        "label", F.explode(F.zip_with("c", F.slice(F.col("c"), 2, 1 << 30), lambda a, b: a * CLASSES + b)).alias("pair")
    ).where("pair is not null")
    counts = pairs.groupBy("pair").agg(F.count_if(F.col("label") == 1).alias("r"), F.count_if(F.col("label") == 0).alias("o"))
    grid = labelled.sparkSession.range(CLASSES * CLASSES).select(F.col("id").cast("int").alias("pair"))
    filled = grid.join(counts, "pair", "left").select(
        "pair", (F.col("pair") / CLASSES).cast("int").alias("first"),
        (F.coalesce("r", F.lit(0)) + SMOOTHING).alias("r"), (F.coalesce("o", F.lit(0)) + SMOOTHING).alias("o"),
    )
    by_first = filled.groupBy("first").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    ratio = F.round(F.log(F.col("r") / F.col("all_r")) - F.log(F.col("o") / F.col("all_o")), 6)
    scored = filled.join(by_first, "first").select("pair", ratio.alias("ratio"))
    return cut(scored.agg(F.transform(F.array_sort(F.collect_list(F.struct("pair", "ratio"))), lambda x: x["ratio"]).alias("ratios")))


def best_stretch(symbols: Column, ratios: Column) -> Column:
    """The largest sum of the log ratios of the symbol pairs of any stretch of SHORTEST symbols or more,
    so that what is ordinary beside a random stretch takes nothing from it; null for a shorter string."""
    classes = _classes(symbols)
    each = F.zip_with(classes, F.slice(classes, 2, 1 << 30), lambda a, b: F.coalesce(F.get(ratios, a * CLASSES + b), F.lit(0.0)))
    each = F.slice(each, 1, F.greatest(F.length(symbols) - 1, F.lit(0)))
    # Of the sum up to a pair goes the least sum up to SHORTEST - 1 pairs before it, or further back.
    none = F.lit(None).cast("double")
    before = F.concat(F.array_repeat(none, SHORTEST - 2), F.array(F.lit(0.0)), each)
    start = F.struct(F.lit(0.0).alias("upto"), F.lit(0.0).alias("before"), F.lit(0.0).alias("least"), none.alias("best"))

    def step(acc: Column, x: Column) -> Column:
        upto, past = acc["upto"] + x["one"], acc["before"] + F.coalesce(x["past"], F.lit(0.0))
        least = F.least(acc["least"], past)
        best = F.when(x["past"].isNotNull() & x["one"].isNotNull(), F.greatest(acc["best"], upto - least)).otherwise(acc["best"])
        return F.struct(upto.alias("upto"), past.alias("before"), least.alias("least"), best.alias("best"))

    return F.aggregate(F.zip_with(each, before, lambda a, b: F.struct(a.alias("one"), b.alias("past"))), start, step, lambda acc: acc["best"])


def _outside(s: Column, base: Column) -> Column:
    """The parts of a span that no base span covers. Base spans are in order of their starts."""
    part = lambda a, b: F.struct(a.alias("start"), b.alias("end"), s["kind"].alias("kind"), F.substr(s["hit"], a - s["start"] + 1, b - a).alias("hit"))
    touching = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    last = F.array(F.struct(s["end"].alias("start"), s["end"].alias("end")))
    parts = F.aggregate(
        F.concat(F.transform(touching, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))), last),
        F.struct(s["start"].alias("at"), F.array().cast("array<struct<start:int,end:int,kind:string,hit:string>>").alias("parts")),
        lambda acc, b: F.struct(
            F.greatest(acc["at"], b["end"]).alias("at"),
            F.when(b["start"] > acc["at"], F.concat(acc["parts"], F.array(part(acc["at"], b["start"])))).otherwise(acc["parts"]).alias("parts"),
        ),
    )
    return F.when(F.size(touching) > 0, parts["parts"]).otherwise(F.array(s))


def scanned(rows: DataFrame, model: DataFrame, text: str, to: str) -> DataFrame:
    """The rows with a column ``to`` of all spans, (start, kind, end) in order: the base ones,
    and candidates with a stretch whose log ratio reaches THRESHOLD, as kind "markov". Such
    a candidate is one span as a whole, as several random parts may lie in it; of one that
    base spans touch, each part outside of them that is long enough is a candidate of its
    own. A null text is an empty one and has no span.
    """
    base, found, ratios = fresh(rows.withColumn(to, F.lit(0)), "base", "found", "ratios")
    t = text_or_empty(F.col(text))
    # Columns of their own: what stands inside a lambda is computed for every element.
    steps = rows.withColumn(base, base_spans(t)).withColumn(found, _if_any(t, CANDIDATE, _pieces(t, CANDIDATE, "3markov", lambda s: F.lit(True))))
    parts = F.when((F.size(base) > 0) & (F.size(found) > 0), F.flatten(F.transform(found, lambda s: _outside(s, F.col(base))))).otherwise(F.col(found))
    steps = steps.withColumn(found, parts).withColumn(ratios, model.scalar())
    random = F.when(F.size(found) > 0, F.filter(found, lambda s: best_stretch(s["hit"], F.col(ratios)) >= THRESHOLD)).otherwise(F.col(found))
    all_spans = F.array_sort(F.concat(base, F.transform(random, lambda s: F.struct(s["start"], s["kind"], s["end"]))))
    return steps.withColumn(to, all_spans).drop(base, found, ratios)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.substr(s["kind"], F.lit(2)), s["start"], s["end"])), ",")


def report(documents: DataFrame, model: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    A row's result depends on its text alone: repeated rows have equal results, a null or
    empty text has no span (the digest is that of an empty string), long texts are
    scanned whole. An empty table gives an empty result. Other columns play no part.
    """
    narrow = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = train(samples(narrow)) if model is None else model
    spans = scanned(narrow, model, "text", "found").select("doc_id", "found")
    kind = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        "doc_id", kind("0assign").alias("n_assign"), kind("1access").alias("n_access"), kind("2hex").alias("n_hex"),
        F.sha2(_joined(F.filter("found", lambda s: s["kind"] != "3markov")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def masked(documents: DataFrame, model: DataFrame | None = None, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """The same rows and columns, every span of the text replaced by ``mark``. Overlapping
    spans get one mark; a text without a span, null included, stays as it is."""
    model = train(samples(documents, text)) if model is None else model
    (found,) = fresh(documents, "found")
    rows = scanned(documents, model, text, found)
    t = F.col(text)
    return rows.withColumn(text, F.when(F.size(found) > 0, _without(t, F.col(found), mark)).otherwise(t)).drop(found)


def _without(text: Column, spans: Column, mark: str) -> Column:
    """A text with each run of overlapping spans replaced. It is taken in blocks, each by itself, as a place in a text is found
    by counting from its start, and spans in chunks, of which a block looks at those that may start in it or reach it."""
    blocks = F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SYMBOLS}}}"), F.lit(0)), lambda x, i: F.struct(x.alias("text"), (i * SYMBOLS).alias("base")))
    last = F.greatest(F.floor((F.size(spans) - 1) / NUMBERS), F.lit(0)).cast("int")

    def ends(some: Column) -> Column:
        return F.array_max(F.transform(some, lambda s: s["end"]))

    def chunk(some: Column) -> Column:
        return F.struct(
            F.element_at(some, 1)["start"].alias("low"), F.element_at(some, -1)["start"].alias("high"), ends(some).alias("reach"), some.alias("spans"))

    def shown(block: Column, start: Column, upto: Column | None) -> Column:
        """Symbols of a block from a place in the text, which may be before or after the block."""
        first = F.greatest(start - block["base"], F.lit(0))
        return F.substr(block["text"], first + 1, F.lit(SYMBOLS) if upto is None else upto - block["base"] - first)

    def of_block(block: Column, chunks: Column) -> Column:
        base = block["base"]
        before = F.array_max(F.transform(
            F.filter(chunks, lambda c: c["low"] < base),
            lambda c: F.when(c["high"] < base, c["reach"]).otherwise(ends(F.filter(c["spans"], lambda s: s["start"] < base)))))
        near = F.filter(chunks, lambda c: (c["high"] >= base) & (c["low"] < base + SYMBOLS))
        own = F.filter(F.flatten(F.transform(near, lambda c: c["spans"])), lambda s: (s["start"] >= base) & (s["start"] < base + SYMBOLS))
        done = F.aggregate(
            own, F.struct(F.coalesce(before, F.lit(0)).alias("at"), F.lit("").alias("out")),
            lambda a, s: F.struct(
                F.greatest(a["at"], s["end"]).alias("at"),
                F.when(s["start"] >= a["at"], F.concat(a["out"], shown(block, a["at"], s["start"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
            ),
        )
        return _let(done, lambda d: F.concat(d["out"], shown(block, d["at"], None)))

    chunks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(spans, i * NUMBERS + 1, F.lit(NUMBERS)))
    return _let(F.transform(chunks, chunk), lambda all_: F.array_join(F.transform(blocks, lambda block: of_block(block, all_)), ""))


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"))


QUERIES = {"op1_secret_scan": op1_secret_scan}
