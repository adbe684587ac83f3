"""Fuzzy line dedup with DataFrame operations only.

Lines (split at "\\n") are normalised: lower case, each run of characters other
than letters and digits one blank. In scripts without blanks between words (Chinese,
Japanese, Thai, Lao, Khmer, Burmese) each character is a word. Normalised lines of
``min_words`` words or more are nodes; of shorter ones only exact repeats go, and
lines without a letter or digit stay.

1. Different lines are counted first, then cut into words once, and get a 64-bit
   SimHash of their distinct words (the frequent ones would outvote the others).
2. Distinct fingerprints that differ in at most 3 bits: cut into five blocks,
   two of them are equal, so each fingerprint is joined on ten block pairs.
3. Lines whose fingerprints are equal or linked are verified: the edit
   similarity of the normalised lines (1 - word edits / words of the longer) must
   be 0.8 or more; words are compared by a letter, which two different words share
   once in 53,248 cases. First each line against the first line of its fingerprint, and
   each fingerprint's first line against those of the smallest and the two next
   smaller fingerprints with which it shares blocks; then all line pairs of equal or
   linked fingerprints that are still in different components. So a large group of
   copies never meets itself pair by pair, and no link that joins two components
   is lost.
4. With ``segments`` (the queries and the pipeline), lines that share a run of
   words at the same place and whose SimHashes differ in at most RUN_BITS bits are
   candidates too: runs of 4 words (of 3 as well in lines of 6 to 16 words, of 2 up
   to 6 words), floor(0.2 n) + 1 of them counted from the line's start and ENDS from
   its end. ``similarity`` 0.8 leaves floor(0.2 n) edits to n words: replaced words
   always leave one run in place. Words put in and taken out in the middle of a
   line, both ends edited, can be missed. A fifth of the distinct words replaced
   changes 13 bits on average with a deviation of 3.2, so the radius loses about one
   such pair in 2,000, more of lines that repeat few words often. Again two
   lines of each run are tried first, then all pairs that are still apart. Of a run
   that more than HOT lines share, those pairs must also share one of their rarest
   words: e edits leave all but e words of the longer line, so a line's rarest
   floor(0.2 n) + 1 and the other's always have one in common. And their PARITY bits,
   each the parity of how many words fall to it, may differ in 2 e places only, two for
   each replaced word. No similar pair is lost by that, and a passage that thousands of
   lines begin with does not pair them all.
5. Each connected group keeps its first occurrence in (doc_id, text hash, line
   number) order; the others are taken out of their documents.

Null and empty texts have no lines to judge and come back as they are. Null
doc_ids come first in the order. Rows that repeat a (doc_id, text) whole count
as one document and get the same result. Other columns stay as they are.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import components

BLOCKS, MAX_BITS, MIN_WORDS, SIMILARITY = 5, 3, 5, 0.8

#: Words of a run, the shortest and the longest line for which such runs are taken (None: any).
RUNS = ((4, 8, None), (3, 6, 16), (2, 2, 6))

#: Runs taken from a line's end.
ENDS = 3

#: Most bits by which lines that share a run may differ to be verified.
RUN_BITS = 24

#: Lines that share a run from which on their pairs must share a rare word too; the
#: longs that hold a line's word parities.
HOT, PARITY = 256, 4

#: Up to which occurrence in a line a word's occurrences are counted apart.
NTH = 4

#: The letters that stand for words where word edits are counted.
LETTERS = "".join(map(chr, range(0x800, 0xD800)))

#: Word hashes summed in one row: the generated code of more is too long to be compiled.
STEP = 8


#: Scripts whose marks are kept as characters, and all scripts without blanks, by
#: code ranges, which are cheaper to test than the script of each character.
MARKED = r"\u0E01-\u0E3A\u0E40-\u0E4E\u0E50-\u0E59\u0E80-\u0EFF\u1000-\u1049\u1050-\u109F\u1780-\u17D3\u17E0-\u17E9"
NO_BLANKS = rf"[\u3005-\u3007\u3041-\u3096\u30A1-\u30FA\u30FC-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{{20000}}-\x{{3FFFD}}{MARKED}]"
BREAK = r"[^\p{L}\p{N}]+"

#: Where the first of those scripts begins: most lines have no character so far on, which one comparison a character tells.
FAR = r"[\u0E01-\x{10FFFF}]"


def line_words(line: str) -> Column:
    """The words of a normalised line."""
    low = F.lower(F.col(line))
    single = F.split(F.regexp_replace(low, NO_BLANKS, " $0 "), BREAK.replace("]", MARKED + "]"))
    return F.array_remove(F.when(low.rlike(FAR) & low.rlike(NO_BLANKS), single).otherwise(F.split(low, BREAK)), "")


def has_words(line: str) -> Column:
    """Whether ``line_words`` finds any, without cutting the line."""
    return F.lower(F.col(line)).rlike(rf"[\p{{L}}\p{{N}}{MARKED}]")


def simhashes(lines: DataFrame) -> DataFrame:
    """``lines`` (keys, hashes: array of word hashes, not empty) with fp in
    place of hashes.

    Rows of STEP word hashes each are summed in 8-bit lanes, eight longs for
    the 64 bits; the rows of a line are then added up in 32-bit lanes. A bias
    lifts the second-highest bit of a lane where more than half have the bit."""
    keys = [c for c in lines.columns if c != "hashes"]
    steps = lines.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(size(hashes) - 1) div {STEP}"))).alias("step"))
    words = steps.select(
        *keys, *(F.expr(f"coalesce(get(hashes, step * {STEP} + {i}), 0L)").alias(f"h{i}") for i in range(STEP)),
        F.expr(f"least({STEP}, size(hashes) - step * {STEP})").alias("n"),
    )
    narrow, wide = sum(1 << k for k in range(0, 64, 8)), (1 << 32) + 1
    lanes = [" + ".join(f"(shiftrightunsigned(h{i}, {k}) & {narrow}L)" for i in range(STEP)) for k in range(8)]
    packed = words.select(*keys, "n", *(F.expr(x).alias(f"l{k}") for k, x in enumerate(lanes)))
    byte = lambda bit: f"(shiftrightunsigned(l{bit % 8}, {bit - bit % 8}) & 255L)"
    sums = [F.sum(F.expr(f"{byte(k)} | shiftleft({byte(k + 32)}, 32)")).alias(f"c{k}") for k in range(32)]
    total = packed.groupBy(*keys).agg(F.sum("n").alias("n"), *sums)
    top, bits = 1 << 30, []
    for k in range(32):
        hit = f"((c{k} + ({top - 1} - n div 2) * {wide}L) & {top * wide}L)"
        bits.append(f"shiftleft({hit}, 1)" if k == 31 else f"shiftrightunsigned({hit}, {30 - k})")
    return total.select(*keys, F.expr(" | ".join(bits)).alias("fp"))


def line_nodes(docs: DataFrame) -> DataFrame:
    """(id, line, norm, times, n_words, code, fp) of the different lines that have
    words: a number, the hashes of the line and of its words, how often the line
    is there, its words as letters, its SimHash.

    Lines are counted as they stand and then cut into words, each once: a filter on
    the words would be moved before the count and cut each line twice more. The
    SimHash's sums need no shuffle of their own: they group by the line, too."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("raw")).where(has_words("raw")).groupBy("raw").agg(F.count("*").alias("times"))
    words = lines.select("raw", "times", F.transform(line_words("raw"), lambda w: F.xxhash64(w)).alias("words"))  # from here on a word is its hash
    letter = F.transform("words", lambda w: F.get(F.split(F.lit(LETTERS), ""), F.pmod(w, F.lit(len(LETTERS))).cast("int")))
    hashed = words.select(
        "raw", "times", F.xxhash64("words").alias("norm"), F.size("words").alias("n_words"), F.array_join(letter, "").alias("code"),
        F.array_distinct("words").alias("hashes"),
    )
    made = simhashes(hashed).withColumn("line", F.xxhash64("raw")).drop("raw")
    return saved(made.withColumn("id", F.monotonically_increasing_id()))


def block_keys(fp: Column) -> Column:
    """Ten keys: two of the five blocks, with their place."""
    ends = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(ends, ends[1:], strict=False)]
    return F.array(
        *(
            F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(block[i], 13)).bitwiseOR(block[j])
            for n, (i, j) in enumerate(combinations(range(BLOCKS), 2))
        )
    )


def near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def shared_blocks(fps: DataFrame) -> DataFrame:
    """(fp, key, low, last, last_but_one) of the fingerprints that are not alone
    with a key: the smallest fingerprint of the key, the one and two before."""
    keyed = not_alone(fps.select("fp", F.explode(block_keys(F.col("fp"))).alias("key")))
    w = Window.partitionBy("key").orderBy("fp")
    return keyed.select("fp", "key", F.first("fp").over(w).alias("low"), F.lag("fp").over(w).alias("last"), F.lag("fp", 2).over(w).alias("last_but_one"))


def not_alone(keyed: DataFrame) -> DataFrame:
    """The rows whose key others have too, with their number ``m``.

    Most keys are there once. They go by a sort of the key alone, a number, which costs
    less than one in the order that the rows that stay are wanted in."""
    return keyed.withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1")


def similar(similarity: float) -> Column:
    """Edit similarity of code_a and code_b of ``similarity`` or more, tried
    within a narrow band of the edit matrix first."""
    longer = "greatest(char_length(code_a), char_length(code_b))"
    bands = [f"levenshtein(code_a, code_b, cast(floor({share} * {longer} + 1e-9) as int)) >= 0" for share in ((1 - similarity) / 4, 1 - similarity)]
    return F.expr(f"case when {bands[0]} then true else {bands[1]} end")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of line ids whose normalised lines are similar."""
    a = texts.select(F.col("id").alias("a"), F.col("code").alias("code_a"))
    b = texts.select(F.col("id").alias("b"), F.col("code").alias("code_b"))
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = pairs.join(a, "a").join(b, "b").repartition(tasks, "a", "b")  # few bytes, much work
    return found.where(similar(similarity)).select("a", "b")


def edits(n: str | Column, similarity: float) -> Column:
    """Most word edits between similar lines the longer of which has ``n`` words."""
    return F.floor((1 - similarity) * (F.col(n) if isinstance(n, str) else n) + 1e-9).cast("int")


def line_runs(texts: DataFrame, similarity: float) -> DataFrame:
    """(key, id): the runs of words of each line by place, from its start one more
    than it may have edits, and the last few from its end.

    One row for each run, numbered through the kinds of runs; of the code, two bytes a
    word, a run is a slice that needs no count of the characters before."""
    kinds = [(q, side, least, most) for q, least, most in RUNS for side in (0, 1)]
    most_runs = lambda q, side: f"least(n div {q}, {ENDS if side else 'edits + 1'})"
    held = [f"if(n >= {least}{'' if most is None else f' and n <= {most}'}, {most_runs(q, side)}, 0)" for q, side, least, most in kinds]
    lines = texts.select("id", F.col("n_words").alias("n"), edits("n_words", similarity).alias("edits"), F.encode("code", "UTF-16BE").alias("c"))
    lines = lines.select("id", "n", "c", *(F.expr(f"cast({x} as int)").alias(f"r{k}") for k, x in enumerate(held)))
    upto = [" + ".join(f"r{x}" for x in range(k + 1)) for k in range(len(kinds))]
    at = lines.where(f"{upto[-1]} > 0").select("*", F.explode(F.expr(f"sequence(0, {upto[-1]} - 1)")).alias("j"))
    pick = lambda of: "case " + " ".join(f"when j < {upto[k]} then {of(k)}" for k in range(len(kinds))) + " end"
    run = at.select(
        "id", "n", "c", F.expr(pick(lambda k: kinds[k][0])).alias("q"), F.expr(pick(lambda k: kinds[k][1])).alias("side"),
        F.expr(pick(lambda k: f"j - ({upto[k - 1]})" if k else "j")).alias("i"),
    )
    first = "if(side = 0, i * q, n - (i + 1) * q)"
    return run.select(F.expr(f"xxhash64(q, side, i, substring(c, 2 * {first} + 1, 2 * q))").alias("key"), "id")


def close(similarity: float, a: str = "a", b: str = "b") -> Column:
    """Line lengths that leave room for ``similarity``, SimHashes within the radius of runs."""
    fits = F.abs(F.col(f"n_{a}") - F.col(f"n_{b}")) <= edits(F.greatest(f"n_{a}", f"n_{b}"), similarity)
    return fits & (F.bit_count(F.col(f"fp_{a}").bitwiseXOR(F.col(f"fp_{b}"))) <= RUN_BITS)


def line_places(texts: DataFrame) -> DataFrame:
    """(id, n_words, word) of each place of a line: the hash of its letter.

    Lines are dealt out by id before they are cut: their letters then are where all
    that is asked by line needs them, and only the short codes are shuffled."""
    at = texts.select("id", "n_words", "code").repartition("id").select("id", "n_words", F.explode(F.split("code", "")).alias("letter"))
    return at.select("id", "n_words", F.xxhash64("letter").alias("word"))


def line_letters(texts: DataFrame) -> DataFrame:
    """(id, n_words, word, nth) of each word of a line, and its how many-eth there: the
    words are counted, not sorted."""
    counted = line_places(texts).groupBy("id", "n_words", "word").agg(F.count("*").alias("times"))
    return counted.select("id", "n_words", "word", F.explode(F.expr("sequence(1, cast(times as int))")).alias("nth"))


def parities(letters: DataFrame) -> DataFrame:
    """(id, p0, p1, ...): 64 PARITY bits of a line, each the parity of the words that fall to it."""
    bit = [F.expr(f"if(pmod(shiftrightunsigned(word, 6), {PARITY}) = {k}, shiftleft(1L, cast(word & 63 as int)), 0L)") for k in range(PARITY)]
    return letters.groupBy("id").agg(*(F.bit_xor(b).alias(f"p{k}") for k, b in enumerate(bit)))


def rare_words(letters: DataFrame, similarity: float) -> DataFrame:
    """(id, word, nth): each line's floor((1 - similarity) n) + 1 rarest words, without those that are there once.

    Any one order of the words will do, so they are ranked by how often they are there,
    those beyond the NTH of a line together: NTH rows for each of LETTERS at most, which
    are broadcast."""
    counted = letters.withColumn("nth_to", F.least("nth", F.lit(NTH)))
    often = counted.groupBy("word", "nth_to").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("often", "word", "nth"))
    ranked = counted.join(F.broadcast(often), ["word", "nth_to"]).withColumn("rank", rank)
    return ranked.where((F.col("rank") <= edits("n_words", similarity) + 1) & (F.col("often") > 1)).select("id", "word", "nth")


def pairs_apart(rows: DataFrame, on: list[str], similarity: float) -> DataFrame:
    """The (a, b) of ``rows`` (a, n_a, ...) that agree in ``on``, are apart and may be similar."""
    columns = [c for c in rows.columns if c.endswith("a")]
    x, y = (rows.select(*on, *(F.col(c).alias(f"{c[:-1]}{end}") for c in columns)) for end in "xy")  # both renamed: one shuffle serves both
    flips = sum(F.bit_count(F.col(f"p{k}_x").bitwiseXOR(F.col(f"p{k}_y"))) for k in range(PARITY))
    alike = close(similarity, "x", "y") & (flips <= 2 * edits(F.greatest("n_x", "n_y"), similarity))
    found = x.join(y, on).where("x < y and root_x <> root_y").where(alike)
    return found.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def run_links(texts: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of similar lines that share a run and that ``links`` leaves apart."""
    shared = not_alone(line_runs(texts, similarity)).select("key", "m", F.col("id").alias("a"))
    groups = components(links)
    sides = texts.select(F.col("id").alias("a"), F.col("n_words").alias("n_a"), F.col("fp").alias("fp_a"))
    named = saved(with_root(shared.join(sides, "a"), groups))
    w = Window.partitionBy("key").orderBy("a")
    side = F.struct("a", "n_a", "fp_a", "root_a")
    ends = named.select(side.alias("y"), F.first(side).over(w).alias("low"), F.lag(side).over(w).alias("last"))
    ends = ends.select("y", F.explode(F.array("low", "last")).alias("x"))
    star = ends.select(*(F.col(f"{end}.{c}").alias(f"{c[:-1]}{end}") for end in "xy" for c in ("a", "n_a", "fp_a", "root_a")))
    star = star.where("x <> y and root_x <> root_y").where(close(similarity, "x", "y"))
    tried = saved(star.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    lines = saved(texts.select("id", "n_words", "code").join(named.select(F.col("a").alias("id")).distinct(), "id", "left_semi"))
    first = saved(verified(tried, lines, similarity))

    groups = components(links.union(first))
    placed = saved(with_root(named.drop("root_a"), groups))
    held = placed.groupBy("key", "m").agg(F.min("root_a").alias("x"), F.max("root_a").alias("y"), F.bit_xor(F.xxhash64("a")).alias("ids"))
    once = held.where("x < y and m > 2").groupBy("m", "ids").agg(F.min("key").alias("key"))  # runs of the same lines; a pair alone was tried
    apart = saved(placed.join(once.select("key"), "key", "left_semi"))
    lines_of = lambda rows: lines.join(rows.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
    marks = parities(line_places(lines_of(apart))).select(F.col("id").alias("a"), *(F.col(f"p{k}").alias(f"p{k}_a") for k in range(PARITY)))
    apart = saved(apart.join(marks, "a"))
    hot = apart.where(F.col("m") > HOT)
    rare = saved(rare_words(line_letters(lines_of(hot)), similarity))
    few = pairs_apart(apart.where(F.col("m") <= HOT), ["key"], similarity)
    both = hot.join(rare.withColumnRenamed("id", "a"), "a").withColumn("at", F.xxhash64("key", "word", "nth"))
    many = pairs_apart(both, ["at"], similarity)
    open_ = saved(few.union(many).distinct().join(tried, ["a", "b"], "left_anti"))  # the joins' files go before the lines' are made
    return first.union(saved(verified(open_, lines, similarity)))


def with_root(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` (a, ...) with root_a, the first line of the group of ``a``."""
    known = groups.select(F.col("node").alias("a"), "root")
    return rows.join(known, "a", "left").withColumn("root_a", F.coalesce("root", "a")).drop("root")


def line_links(nodes: DataFrame, similarity: float, segments: bool) -> DataFrame:
    """(a, b) of lines that are similar, one path at least between any two of a group."""
    fps = saved(nodes.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    block = saved(shared_blocks(fps))
    other = block.select(F.col("fp").alias("b"), "key")
    linked = saved(block.join(other, [block["key"] == other["key"], F.col("fp") != F.col("b"), near("fp", "b")], "left_semi").select("fp").distinct())
    several = fps.where("n > 1").select("fp").union(linked).distinct()
    member = saved(nodes.select("id", "fp", "code").join(several, "fp", "left_semi").join(fps, "fp").select("id", "fp", "rep", "code"))
    block = saved(block.join(linked, "fp", "left_semi"))
    own = member.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    star = [
        block.where(F.col(end) != F.col("fp")).where(near(end, "fp")).select(F.col(end).alias("fa"), F.col("fp").alias("fb"))
        for end in ("low", "last", "last_but_one")
    ]
    ends = [fps.select(F.col("fp").alias(f"f{x}"), F.col("rep").alias(x)) for x in "ab"]
    star = reduce(DataFrame.union, star).distinct().join(ends[0], "fa").join(ends[1], "fb").select("a", "b")
    found = saved(verified(own.union(star), member, similarity))

    placed = saved(_placed(member, found))
    part = placed.select("fp", "root").distinct()
    same = part.groupBy("fp").count().where("count > 1").select("fp", F.lit(None).cast("long").alias("key"))
    keyed = block.select("fp", "key").union(same).join(part, "fp").select("fp", F.coalesce("key", "fp").alias("key"), F.col("key").isNull().alias("own"), "root")
    ka, kb = (keyed.select("key", "own", *(F.col(c).alias(f"{c}_{x}") for c in ("fp", "root"))) for x in "ab")
    open_ = (
        ka.join(kb, ["key", "own"])
        .where("root_a < root_b")
        .where(near("fp_a", "fp_b"))
        .select("fp_a", "root_a", "fp_b", "root_b")
        .distinct()
    )
    ma, mb = (placed.select(*(F.col(c).alias(f"{c}_{x}") for c in ("fp", "root")), F.col("id").alias(x)) for x in "ab")
    more = verified(open_.join(ma, ["fp_a", "root_a"]).join(mb, ["fp_b", "root_b"]).select("a", "b").distinct(), member, similarity)
    links = saved(found.union(more))
    if segments:
        links = links.union(run_links(nodes, links, similarity))
    return links


def _placed(member: DataFrame, links: DataFrame) -> DataFrame:
    groups = components(links)
    return member.join(groups, member["id"] == groups["node"], "left").select("id", "fp", F.coalesce("root", "id").alias("root"))


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, segments: bool = False) -> DataFrame:
    """(doc_id, text_hash, removed): the line numbers that go, by document."""
    nodes = line_nodes(docs)
    first = F.min("id").over(Window.partitionBy("norm"))
    equal = saved(nodes.select(first.alias("a"), F.col("id").alias("b")).where("a <> b"))
    judged = nodes.where(F.col("n_words") >= max(1, min_words))
    groups = components(equal.union(line_links(judged, similarity, segments)))
    rooted = groups.select(F.col("node").alias("id"), "root").union(groups.select("root", "root").distinct())
    repeated = nodes.select("id", "line", "times").join(rooted, "id", "left").where("root is not null or times > 1")
    repeated = saved(repeated.select("line", F.coalesce("root", "id").alias("root")))
    at = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    found = saved(at.select("doc_id", "text_hash", "line_no", F.xxhash64("raw").alias("line")).join(repeated, "line").drop("line"))
    place = F.struct("doc_id", "text_hash", "line_no")
    gone = found.join(found.groupBy("root").agg(F.min(place).alias("kept")), "root").where(~place.eqNullSafe(F.col("kept")))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("removed"))


def without(docs: DataFrame, removed: DataFrame, n_lines: str, n_removed: str) -> DataFrame:
    """``docs`` with the text without those lines, and how many there were and
    are gone in columns of the given names, which ``docs`` must not have."""
    held = {*docs.columns, n_lines, n_removed}
    doc, hash_, gone, lines = (fresh(name, held) for name in ("_doc", "_hash", "_gone", "_lines"))
    found = removed.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hash_), F.col("removed").alias(gone))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[doc]) & (F.xxhash64(docs["text"]) == found[hash_]), "left")
    split = joined.select(*docs.columns, gone, F.split("text", "\n").alias(lines))
    index = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(index, lambda i: F.get(F.col(lines), i)), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    return split.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_removed),
    )


def fresh(name: str, held: set[str]) -> str:
    """``name``, with underscores in front until no column is called so."""
    while name.lower() in {h.lower() for h in held}:
        name = "_" + name
    return name


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, segments: bool = False) -> DataFrame:
    """doc_id, text (without the repeated lines), n_lines, n_removed."""
    own = docs.select("doc_id", "text")
    return without(own, removed_lines(own, min_words, similarity, segments), "n_lines", "n_removed")


def clean_documents(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, segments: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of the texts; all rows stay."""
    removed = removed_lines(docs.select("doc_id", "text"), min_words, similarity, segments)
    counts = [fresh(name, {*docs.columns}) for name in ("_n_lines", "_n_removed")]
    return without(docs, removed, *counts).drop(*counts)
