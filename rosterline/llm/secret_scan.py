"""Secrets in texts: fixed patterns plus a randomness test battery, with DataFrame functions only.

Patterns give the base spans (kinds assign, access, hex).  The battery looks at every further run of 16 or more
characters of the usual encodings that mixes letter cases or letters and digits; the hyphens of a UUID don't count.  For
the encoding inferred from its characters it tests
- uniformity: chi-squared of the symbols (hex digits, or letters regardless of case) and of the shares of small letters,
  capitals, digits and signs,
- runs: changes between these classes from one character to the next (names and paths change at words, random strings
  nearly everywhere),
- serial correlation of neighbouring symbols,
each as a z-value; the sum of their squares is small for random strings.  A candidate must pass as random: strings that
are exceed ``RANDOM`` with a chance of about 0.1 %.

False discoveries are controlled against ordinary writing: in every length class, the letters of every text are cut into
as many stretches as they fill, one after another, which go through the same battery, dressed as each encoding would
have them: capitals, signs or digits at words, and letters folded into hex digits (sums are counted on bit planes).  Texts with equal words count once, so that copies don't decide a class.
A candidate's p-value is the share of stretches of its length class that look as random as it does.  P-values are
weighted by the candidate's bits (long strings get more of the error budget), and the Benjamini-Hochberg rule over all
candidates of the corpus decides which are reported as kind random.

Positions are code points, ends exclusive.  Null texts count as empty, empty texts have no spans, rows with equal or
null ids each get their own result, an empty table gives an empty result, and all columns of the input pass through (one named
secrets is replaced).
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import others, stage

#: The base patterns.  Group 2 of assign must have 12 characters or more.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

#: What the battery looks at: runs of this many characters or more.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
#: The rate of false discoveries that is allowed among the spans of kind random.
RATE = 0.05
#: Alphabet sizes of the encodings that are told apart: hex, letters of one case with digits, base 62, base 64.
ALPHABETS = (16, 36, 62, 64)
#: Shares of small letters (or of the only case), capitals, digits and signs in random strings of an alphabet.
SHARES = {16: (6 / 16, 0, 10 / 16, 0), 36: (26 / 36, 0, 10 / 36, 0), 62: (26 / 62, 26 / 62, 10 / 62, 0), 64: (26 / 64, 26 / 64, 10 / 64, 2 / 64)}
#: Largest statistic that still counts as random (simulated: its 99.9 % point is 40 to 58 at all sizes and lengths).
RANDOM = 50.0
#: Fewer symbols than this aren't tested for uniformity and serial correlation.
FEWEST = 8
#: Length classes: their lower ends.
LENGTHS = (16, 20, 24, 32, 48, 64, 96, 128)
#: Hits of a text that are placed or replaced together; the work is the number of hits times this at most.
TOGETHER = 128
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none(kind: str = _SPAN) -> Column:
    return F.from_json(F.lit("[]"), kind)


def _bound(x: Column, f) -> Column:
    """f(x) with x computed once: inside a function over an array, an expression would be computed for each item."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _chunks(items: Column) -> Column:
    """An array (not empty) as arrays of TOGETHER items, so that what grows by an item at a time grows within a short array."""
    def cut(x: Column) -> Column:
        n = F.ceil(F.size(x) / TOGETHER).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(x, k * TOGETHER + 1, TOGETHER))

    return _bound(items, cut)


def _placed(pieces: str, hits: str) -> Column:
    """start and end of each hit, from the pieces between the hits (there is a hit)."""
    kind = "array<struct<start:int,end:int>>"
    zipped = F.arrays_zip(F.col(pieces).alias("p"), F.col(hits).alias("h"))
    start = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.coalesce(F.length(x["h"]), F.lit(0))
        out = F.when(x["h"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))))
        return F.struct(end.alias("at"), out.alias("out"))

    def moved(acc: Column, x: Column) -> Column:
        """Chunks with the place where they begin."""
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), x["out"].alias("out")))).alias("out"))

    chunks = F.transform(_chunks(zipped), lambda c: F.aggregate(c, start, step))
    begin = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), f"array<struct<from:int,out:{kind}>>").alias("out"))
    located = F.aggregate(chunks, begin, moved, lambda acc: acc["out"])
    shift = lambda c: F.transform(c["out"], lambda x: F.struct((x["start"] + c["from"]).alias("start"), (x["end"] + c["from"]).alias("end")))
    return F.flatten(F.transform(located, shift))


def _found(df: DataFrame, name: str, pattern: str, group: int, gate: Column, source: str = "_text") -> DataFrame:
    """Adds ``name``: start, end and text (of ``group``) of the leftmost non-overlapping matches in ``source``."""
    pieces, hits, texts = f"{name}_p", f"{name}_h", f"{name}_g"
    empty = F.from_json(F.lit("[]"), "array<string>")
    df = df.withColumn(pieces, F.when(gate, F.split(source, pattern, -1)).otherwise(empty))
    df = df.withColumn(hits, F.when(gate, F.regexp_extract_all(source, F.lit(pattern), F.lit(0))).otherwise(empty))
    text = hits
    if group:
        df = df.withColumn(texts, F.when(gate, F.regexp_extract_all(source, F.lit(pattern), F.lit(group))).otherwise(empty))
        text = texts
    df = df.withColumn(f"{name}_s", F.when(F.size(hits) > 0, _placed(pieces, hits)).otherwise(F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")))
    both = F.zip_with(f"{name}_s", text, lambda s, t: F.struct(s["start"].alias("start"), s["end"].alias("end"), t.alias("text")))
    return df.withColumn(name, both).drop(pieces, hits, texts, f"{name}_s")


def _chi(n: Column, size: int, squares: Column) -> Column:
    """Chi-squared z-value of ``n`` symbols of an alphabet of ``size``, 0 or more; ``squares``: sum of squared counts."""
    return F.greatest((squares * size / n - n - (size - 1)) / F.sqrt(2.0 * (size - 1) * (n - 1) / n), F.lit(0.0))


def _kinds(n: Column, shares: tuple[float, ...], counts: list[Column]) -> Column:
    """z-value, 0 or more, of the numbers of small letters, capitals, digits and signs against their shares."""
    held = [(c, p) for c, p in zip(counts, shares) if p]
    chi = functools.reduce(operator.add, [F.pow(c - n * p, F.lit(2.0)) / (n * p) for c, p in held])
    free = len(held) - 1
    return F.greatest((chi - free) / math.sqrt(2 * free), F.lit(0.0))


def _runs(n: Column, shares: tuple[float, ...], changes: Column) -> Column:
    """z-value of the changes of class between neighbours, against independent characters of these shares."""
    differ = 1 - sum(p * p for p in shares)
    both = sum(p * (1 - p) ** 2 for p in shares) - differ * differ
    return (changes - (n - 1) * differ) / F.sqrt((n - 1) * (differ - differ * differ) + 2 * (n - 2) * both)


def _serial(n: Column, total: Column, square: Column, product: Column, ends: Column) -> Column:
    """z-value of the lag-1 correlation, from the symbols' sums, products of neighbours, and first plus last symbol."""
    mean = total / n
    spread = square - n * mean * mean
    lag = product - mean * (2 * total - ends) + (n - 1) * mean * mean
    return F.when(spread > 0, (lag / spread + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))


def _statistic(codes: Column, size: int) -> Column:
    """The battery's statistic of character codes, for the alphabet of ``size`` symbols."""
    fold = 16 if size == 16 else 26
    digit, lower, upper = (lambda c, lo=lo, hi=hi: c.between(lo, hi) for lo, hi in ((48, 57), (97, 122), (65, 90)))
    one_case = size in (16, 36)

    def kind(c: Column) -> Column:
        return F.when(lower(c), 0).when(upper(c), 0 if one_case else 1).when(digit(c), 2).otherwise(3)

    def classes(x: Column) -> Column:
        """kinds² + runs² of the characters' classes ``x``."""
        n = F.size(x).cast("double")
        names = ("k0", "k1", "k2", "k3", "changes")
        first = F.struct(*(F.lit(0.0).alias(a) for a in names), F.lit(-1).alias("last"))

        def step(acc: Column, v: Column) -> Column:
            counts = [(acc[f"k{k}"] + F.when(v == k, 1.0).otherwise(0.0)).alias(f"k{k}") for k in range(4)]
            changes = acc["changes"] + F.when((acc["last"] >= 0) & (acc["last"] != v), 1.0).otherwise(0.0)
            return F.struct(*counts, changes.alias("changes"), v.alias("last"))

        def end(acc: Column) -> Column:
            z, r = _kinds(n, SHARES[size], [acc[f"k{k}"] for k in range(4)]), _runs(n, SHARES[size], acc["changes"])
            return z * z + r * r

        return F.aggregate(x, first, step, end)

    def symbols(x: Column) -> Column:
        """chi² + serial² of the symbols ``x``."""
        n = F.size(x).cast("double")
        # sum of squared counts, from the lengths of the runs of equal symbols once they are sorted
        run = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("length"), F.lit(-1).alias("last"))

        def count(acc: Column, v: Column) -> Column:
            length = F.when(v == acc["last"], acc["length"] + 1).otherwise(1.0)
            return F.struct((acc["sum"] + 2 * length - 1).alias("sum"), length.alias("length"), v.alias("last"))

        squares = F.aggregate(F.array_sort(x), run, count, lambda acc: acc["sum"])
        first = F.struct(*(F.lit(0.0).alias(a) for a in ("sum", "square", "product")), F.lit(-1).alias("last"))

        def step(acc: Column, v: Column) -> Column:
            d, before = v.cast("double"), acc["last"].cast("double")
            product = acc["product"] + F.when(acc["last"] >= 0, d * before).otherwise(0.0)
            return F.struct((acc["sum"] + d).alias("sum"), (acc["square"] + d * d).alias("square"), product.alias("product"), v.alias("last"))

        def end(acc: Column) -> Column:
            ends = F.element_at(x, 1).cast("double") + F.element_at(x, -1).cast("double")
            chi, serial = _chi(n, fold, squares), _serial(n, acc["sum"], acc["square"], acc["product"], ends)
            return chi * chi + serial * serial

        return F.when(F.size(x) < FEWEST, 0.0).otherwise(F.aggregate(x, first, step, end))

    letter = lambda c: F.when(lower(c), c - 97).otherwise(c - 65)
    if size == 16:
        drawn = F.transform(codes, lambda c: F.when(digit(c), c - 48).otherwise(letter(c) + 10))
    else:
        drawn = F.transform(F.filter(codes, lambda c: lower(c) | upper(c)), letter)
    return _bound(F.transform(codes, kind), classes) + _bound(drawn, symbols)


def _bin(value: Column) -> Column:
    """Steps of 0.05; what exceeds RANDOM is one step, since none of it is reported."""
    return F.least(F.floor(value * 20), F.lit(int(RANDOM * 20))).cast("long")


def _number(x: int) -> Column:
    """64 bits as a long."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


#: Steps that turn a square of 8 by 8 bits, a byte each row: what stays, what moves, how far it moves (as in Hacker's Delight).
TURNS = ((0xAA55AA55AA55AA55, 0x00AA00AA00AA00AA, 7), (0xCCCC3333CCCC3333, 0x0000CCCC0000CCCC, 14), (0xF0F0F0F00F0F0F0F, 0x00000000F0F0F0F0, 28))


def _planes(rows: DataFrame, kept: list[str], pieces: range) -> DataFrame:
    """``kept`` and w0_j to w5_j: the six low bits of a piece's 64 letters, the first letter in the highest bit.

    ``rows`` has e0_j to e7_j, numbers of eight bytes, a letter each.  One bit of each letter is put into a square, a row for the
    places within the numbers and a column for the numbers, and the square is turned.  Each step is a projection of its own
    that names a number once or thrice: written out as one expression it would be too large a method for the JVM to compile.
    """
    names = [f"w{b}_{j}" for j in pieces for b in range(6)]

    def square(j: int, b: int) -> Column:
        one = [F.shiftright(f"e{i}_{j}", b).bitwiseAND(_number(0x0101010101010101)) for i in range(8)]
        return functools.reduce(Column.bitwiseOR, [F.shiftleft(x, 7 - i) for i, x in enumerate(one)])

    def turned(w: Column, stay: int, move: int, far: int) -> Column:
        there, back = F.shiftleft(w.bitwiseAND(_number(move)), far), F.shiftright(w, far).bitwiseAND(_number(move))
        return w.bitwiseAND(_number(stay)).bitwiseOR(there).bitwiseOR(back)

    rows = rows.select(*kept, *(square(j, b).alias(f"w{b}_{j}") for j in pieces for b in range(6)))
    for step in TURNS:
        rows = rows.select(*kept, *(turned(F.col(w), *step).alias(w) for w in names))
    return rows


def _ordinary(docs: DataFrame) -> DataFrame:
    """size, cell, bin of every stretch of letters of the distinct texts (_text), in every length class they fill.

    Letters are numbers of five bits, from 1.  64 letters become five bit planes, and a sixth of the letters that begin a
    word (capitals, whose bit of 32 isn't set); a stretch takes its bits out of them by shifts (up to 64 letters in lo, the
    rest in hi), and counts, sums and products are numbers of set bits.  So no step goes over single letters.

    With w words begun in a stretch of n letters: in hex digits (letters modulo 16) and in 36 symbols every second word
    ends in a digit, so that it changes class w times; in 62, words have a capital, in 64 a sign, and it changes 2 w times.
    """
    texts = docs.select(F.initcap(F.btrim(F.regexp_replace("_text", "[^A-Za-z]+", " "))).alias("words")).where(F.length("words") >= LENGTHS[0]).distinct()
    texts = texts.select(F.replace("words", F.lit(" "), F.lit("")).alias("letters")).where(F.length("letters") >= LENGTHS[0])
    # a row for every 64 letters, with the two pieces that follow, so that stretches are cut within a row
    texts = texts.select(F.length("letters").alias("length"), F.regexp_extract_all("letters", F.lit(".{1,64}"), F.lit(0)).alias("p"))
    behind = lambda k: F.slice("p", k + 1, F.size("p"))
    rows = texts.select("length", F.posexplode(F.arrays_zip(F.col("p").alias("p0"), behind(1).alias("p1"), behind(2).alias("p2"))).alias("k", "z"))
    # (what fills the last piece up has no bit but that of 32)
    rows = rows.select("length", "k", *(F.hex(F.rpad(F.coalesce(F.col("z")[f"p{j}"], F.lit("")), 64, "`")).alias(f"h{j}") for j in range(3)))
    eight = lambda j, i: F.conv(F.substring(f"h{j}", 16 * i + 1, 16), 16, 10).cast("long")
    rows = rows.select("length", "k", *(eight(j, i).alias(f"e{i}_{j}") for j in range(3) for i in range(8)))
    rows = _planes(rows, ["length", "k"], range(3))
    rows = rows.select("length", "k", *((F.bitwise_not(w) if b == 5 else F.col(w)).alias(w) for j in range(3) for b in range(6) for w in [f"w{b}_{j}"]))
    # stretches of up to 64 letters need no hi
    short, long = ([n for n in LENGTHS if (n > 64) is far] for far in (False, True))
    return _stretches(rows, short, ("lo",)).union(_stretches(rows, long, ("lo", "hi")))


def _stretches(rows: DataFrame, lengths: list[int], parts: tuple[str, ...]) -> DataFrame:
    """size, cell, bin of the stretches of some length classes; ``rows``: a text's length, the piece's number k, and the planes
    w0_j to w5_j of it (j = 0) and the two that follow.  A stretch belongs to the piece where it begins."""
    left, right = (lambda x, k, f=f: F.call_function(f, x, k) for f in ("shiftleft", "shiftrightunsigned"))
    bits, col = F.bit_count, F.col
    rows = rows.withColumn("cell", F.explode(F.array(*map(F.lit, lengths))))
    cell, offset, begin = F.col("cell"), F.col("at"), F.col("k") * 64
    first = F.pmod(-begin, cell)  # of the stretches that begin in the piece, from its start
    rows = rows.withColumn("first", first).withColumn("last", F.least(F.lit(63), F.col("length") - cell - begin)).where("first <= last")
    rows = rows.withColumn("at", F.explode(F.sequence("first", "last", "cell"))).drop("first", "last", "k", "length")
    rest = cell - 64

    def word(b: int, k: int) -> Column:
        """64 letters from the stretch's letter 64 * k, the first in the highest bit."""
        return left(col(f"w{b}_{k}"), offset).bitwiseOR(right(right(col(f"w{b}_{k + 1}"), F.lit(1)), 63 - offset))

    def cut(x: Column, part: str) -> Column:
        """The first letters of 64, as many as the part has, the last one in the lowest bit."""
        if part == "lo":
            return right(x, 64 - F.least(cell, F.lit(64)))
        return right(x, 64 - rest)

    masks = [cut(word(b, k), part).alias(f"{part}{b}") for k, part in enumerate(parts) for b in range(6)]
    valid = [cut(F.lit(-1).cast("long"), part).alias(part) for part in parts]
    rows = rows.select("cell", *masks, *valid)
    both = lambda f: total([f(p) for p in parts])
    bit = lambda part, b: F.col(f"{part}{b}")

    last = lambda x: x.bitwiseAND(F.lit(1).cast("long")).cast("int")
    # the letters on both sides of the place where hi follows lo, and those at the ends
    hi_first = lambda x: last(right(x, rest - 1))
    lo_first = lambda x: last(right(x, F.least(cell, F.lit(64)) - 1))
    end = lambda b: last(bit(parts[-1], b))
    total = lambda xs: functools.reduce(operator.add, xs)
    value = lambda f, n: total(f(b) * (1 << b) for b in range(n))

    def product(n: int) -> Column:
        pairs = [both(lambda p, b=b, c=c: bits(right(bit(p, b), F.lit(1)).bitwiseAND(bit(p, c)))) * (1 << b + c) for b in range(n) for c in range(n)]
        return total(pairs) + (value(lambda b: last(bit("lo", b)), n) * value(lambda b: hi_first(bit("hi", b)), n) if "hi" in parts else F.lit(0))

    pairs = [(f"product{n}", product(n)) for n in (4, 5)]
    pairs += [(f"sum{n}", value(lambda b: both(lambda p, b=b: bits(bit(p, b))), n)) for n in (4, 5)]
    pairs += [(f"ends{n}", value(lambda b: lo_first(bit("lo", b)) + end(b), n)) for n in (4, 5)]
    pairs += [("begun", both(lambda p: bits(bit(p, 5))))]
    rows = rows.select("cell", *(f"{p}{b}" for p in parts for b in ("", *range(5))), *(c.cast("double").alias(n) for n, c in pairs))
    kept = ["cell", *(n for n, _ in pairs)]

    def chosen(part: str, code: int, planes: range) -> list[Column]:
        """The planes as they are where the code has a bit, else inverted."""
        return [bit(part, b) if code >> b - planes[0] & 1 else F.bitwise_not(bit(part, b)) for b in planes]

    # (small steps: methods of more than 8,000 bytes of code aren't compiled)
    meet = lambda xs: functools.reduce(Column.bitwiseAND, xs)
    tops = [meet([F.col(p), *chosen(p, t, range(2, 5))]).alias(f"{p}_top{t}") for p in parts for t in range(7)]
    lows = [meet(chosen(p, t, range(2))).alias(f"{p}_low{t}") for p in parts for t in range(4)]
    rows = rows.select(*kept, *tops, *lows)
    number = lambda k: both(lambda p: bits(F.col(f"{p}_top{k >> 2}").bitwiseAND(F.col(f"{p}_low{k & 3}"))).cast("double"))
    rows = rows.select(*kept, *(number(k).alias(f"c{k}") for k in range(1, 27)))
    names = {26: {k: f"c{k}" for k in range(1, 27)}, 16: {0: "c16"} | {k: f"d{k}" if k < 11 else f"c{k}" for k in range(1, 16)}}

    def squared(m: int) -> list[Column]:
        cs = {k: F.col(c) for k, c in names[m].items()}
        return [total(c * c for c in cs.values()).alias(f"squares{m}"), total(c * float(k * k) for k, c in cs.items()).alias(f"square{m}")]

    rows = rows.select(*kept, *squared(26), *(f"c{k}" for k in range(11, 17)), *((F.col(f"c{k}") + F.col(f"c{k + 16}")).alias(f"d{k}") for k in range(1, 11)))
    rows = rows.select(*kept, "squares26", "square26", *squared(16)).withColumn("n", F.col("cell").cast("double"))
    n = F.col("n")
    rows = rows.select("*", *(_serial(n, *(col(c) for c in (f"sum{k}", f"square{m}", f"product{k}", f"ends{k}"))).alias(f"serial{m}") for m, k in ((16, 4), (26, 5))))
    w, zero = col("begun"), F.lit(0.0)
    twice = F.least(2 * w, n - 1)
    rows = rows.select(
        "cell", "n", "serial16", "serial26", _chi(n, 16, col("squares16")).alias("chi16"), _chi(n, 26, col("squares26")).alias("chi26"),
        *(_runs(n, SHARES[a], w).alias(f"runs{a}") for a in (16, 36)), *(_kinds(n, SHARES[a], [n - w / 2, zero, w / 2, zero]).alias(f"kinds{a}") for a in (16, 36)),
        _runs(n, SHARES[62], twice).alias("runs62"), _kinds(n, SHARES[62], [n - w, w, zero, zero]).alias("kinds62"),
        _runs(n, SHARES[64], twice).alias("runs64"), _kinds(n, SHARES[64], [n - w, zero, zero, w]).alias("kinds64"),
    )
    sum_of = lambda a: total(col(c) * col(c) for c in (f"runs{a}", f"kinds{a}", *(("chi16", "serial16") if a == 16 else ("chi26", "serial26"))))
    rows = rows.select("cell", *(_bin(sum_of(a)).alias(f"bin{a}") for a in ALPHABETS))
    return rows.select("cell", F.explode(F.array(*(F.struct(F.lit(a).alias("size"), F.col(f"bin{a}").alias("bin")) for a in ALPHABETS))).alias("x")).select("x.size", "cell", "x.bin")


def _class_of(length: Column) -> Column:
    out = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        out = F.when(length >= low, F.lit(low)).otherwise(out)
    return out


def _size_of(token: Column) -> Column:
    """Alphabet size of the encoding that the characters suggest; null if it is a number or a plain word."""
    word = token.rlike("^[A-Z]?[a-z]+$") | token.rlike("^[A-Z]+$") | token.rlike("^[0-9]+$")
    one_case = token.rlike("^[0-9a-z]+$") | token.rlike("^[0-9A-Z]+$")
    hexadecimal = token.rlike("^[0-9a-f]+$") | token.rlike("^[0-9A-F]+$")
    return F.when(word, F.lit(None)).when(hexadecimal, F.lit(16)).when(one_case, F.lit(36)).when(token.rlike("^[0-9A-Za-z]+$"), F.lit(62)).otherwise(F.lit(64))


def _base(df: DataFrame) -> DataFrame:
    """Adds base: the spans of the patterns."""
    df = _found(df, "assign", ASSIGN, 2, F.col("_text").contains("=") | F.col("_text").contains(":"))
    df = _found(df, "access", ACCESS, 0, F.col("_text").contains("AKIA"))
    df = _found(df, "hex", HEX, 0, F.col("_text").rlike(HEX))
    span = lambda kind: lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))
    parts = [F.transform(F.filter("assign", lambda x: F.length(x["text"]) >= 12), span(0)), F.transform("access", span(1)), F.transform("hex", span(2))]
    return df.withColumn("base", F.array_sort(F.concat(*parts))).drop("assign", "access", "hex")


def _tested(df: DataFrame, source: str = "_text") -> DataFrame:
    """Adds tests: start, end, length class, alphabet size and codes of the long tokens of ``source``."""
    df = _found(df, "token", TOKEN, 0, F.col(source).rlike(TOKEN), source)
    codes = lambda t: F.transform(F.split(t, ""), lambda c: F.ascii(c))
    plain = lambda x: F.when(x["text"].rlike(UUID), F.lower(F.replace(x["text"], F.lit("-"), F.lit("")))).otherwise(x["text"])
    df = df.withColumn("token", F.transform("token", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), plain(x).alias("text"))))
    kept = F.filter("token", lambda x: _size_of(x["text"]).isNotNull())
    return df.withColumn("tests", F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.length(x["text"]).alias("n"), _size_of(x["text"]).alias("size"), codes(x["text"]).alias("codes")))).drop("token")


def _value(x: Column) -> Column:
    """The statistic of a candidate for its own alphabet."""
    out = F.lit(None).cast("double")
    for size in ALPHABETS:
        out = F.when(x["size"] == size, _statistic(x["codes"], size)).otherwise(out)
    return out


def thresholds(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> dict[tuple[int, int], float]:
    """(alphabet size, length class) -> largest statistic that is reported.

    Both sides are counted over all documents as histograms of the statistic (steps of 0.05), so that the driver gets
    one number for each of the at most 44 cells.
    """
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    found = F.transform("tests", lambda x: F.struct(x["size"].alias("size"), _class_of(x["n"]).alias("cell"), _bin(_value(x)).alias("bin"), x["n"].alias("n")))
    found = _tested(texts).select(F.explode(found).alias("x")).select("x.*")
    sides = found.groupBy("size", "cell", "bin").agg(F.lit(0).cast("long").alias("null_n"), F.count("*").alias("n"), F.sum("n").alias("length"))
    null = _ordinary(texts).groupBy("size", "cell", "bin").agg(F.count("*").alias("null_n"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("length"))
    both = sides.union(null).groupBy("size", "cell", "bin").agg(*(F.sum(c).alias(c) for c in ("null_n", "n", "length")))
    # many columns make generated methods that the JVM wouldn't compile; below this limit Spark runs step by step instead
    conf, limit = docs.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    before = conf.get(limit)
    conf.set(limit, "8000")
    try:
        both = stage(both.withColumn("length", F.when(F.col("n") > 0, F.col("length") / F.col("n"))), "battery")
    finally:
        conf.set(limit, before)
    # p-values by cell: the share of ordinary stretches whose statistic is as small
    upto = Window.partitionBy("size", "cell").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("size", "cell")
    both = both.withColumn("p", (1 + F.sum("null_n").over(upto)) / (1 + F.sum("null_n").over(whole))).where("n > 0")
    # weights: bits of the strings, with mean 1 over all candidates
    rows = both.withColumn("bits", F.col("length") * F.log2(F.col("size")))
    total = rows.agg(F.sum("n").alias("m"), (F.sum(F.col("n") * F.col("bits")) / F.sum("n")).alias("bits")).first()
    if not total["m"]:
        return {}
    rows = rows.withColumn("q", F.round(F.col("p") * total["bits"] / F.col("bits"), 6))
    # Benjamini-Hochberg over the distinct weighted p-values (six digits: bounded)
    rows = rows.withColumn("q", F.when(F.col("bin") < int(RANDOM * 20), F.col("q")).otherwise(F.greatest("q", F.lit(1.0))))
    ranked = rows.groupBy("q").agg(F.sum("n").alias("n"))
    ranked = ranked.withColumn("k", F.sum("n").over(Window.orderBy("q").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cut = ranked.where(F.col("q") <= F.col("k") * rate / total["m"]).agg(F.max("q")).first()[0]
    if cut is None:
        return {}
    cells = rows.where(F.col("q") <= cut).groupBy("size", "cell").agg(F.max("bin").alias("bin")).collect()
    return {(r["size"], r["cell"]): min((r["bin"] + 1) / 20, RANDOM) for r in cells}


def scan(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """All columns of ``docs`` with ``secrets`` added: start, kind (index into KINDS) and end, by start and kind."""
    cut = thresholds(docs, text_col, rate)
    names = docs.columns
    df = docs.toDF(*(f"c{k}" for k in range(len(names)))).withColumn("_text", F.coalesce(F.col(f"c{names.index(text_col)}").cast("string"), F.lit("")))
    df = _base(df)
    if cut:
        # base spans are blanked, so that the battery sees what is beside them only
        df = _tested(df.withColumn("_free", _rewritten(F.col("_text"), F.col("base"), lambda n, _: F.repeat(F.lit(" "), n))), "_free")

        def reported(x: Column) -> Column:
            most = F.lit(None).cast("double")
            for (size, cell), value in cut.items():
                most = F.when((x["size"] == size) & (_class_of(x["n"]) == cell), F.lit(value)).otherwise(most)
            return x["size"].isNotNull() & most.isNotNull() & (_value(x) < most)

        df = df.withColumn("more", F.filter("tests", reported))
        more = F.transform("more", lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
        df = df.withColumn("base", F.array_sort(F.concat("base", more)))
    return df.select(*(F.col(f"c{k}").alias(n) for k, n in others(names, ["secrets"])), F.col("base").alias("secrets"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kind = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _rewritten(text: Column, spans: Column, mark) -> Column:
    """The text with ``mark`` (of the number of characters a span adds to the ones before, and whether it overlaps them) in
    place of every span.

    Spans are taken TOGETHER at a time: each chunk of them works on the part of the text between its first and last span.
    """
    ends = lambda c: F.aggregate(c, F.lit(0), lambda acc, x: F.greatest(acc, x["end"]))
    kind = "array<struct<from:int,to:int,spans:array<struct<start:int,kind:int,end:int>>>>"
    begin = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), kind).alias("out"))

    def locate(acc: Column, c: Column) -> Column:
        upto = F.greatest(acc["at"], ends(c))
        return F.struct(upto.alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), upto.alias("to"), c.alias("spans")))).alias("out"))

    def replaced(c: Column) -> Column:
        def within(p: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

            def step(acc: Column, x: Column) -> Column:
                first, stop, zero = x["start"] - c["from"], x["end"] - c["from"], F.lit(0)
                added = F.greatest(stop - F.greatest(acc["at"], first), zero)
                more = F.concat(acc["out"], p.substr(acc["at"] + 1, F.greatest(first - acc["at"], zero)), mark(added, first < acc["at"]))
                return F.struct(F.greatest(acc["at"], stop).alias("at"), more.alias("out"))

            return F.aggregate(c["spans"], start, step, lambda acc: acc["out"])

        return _bound(text.substr(c["from"] + 1, c["to"] - c["from"]), within)

    whole = lambda x: F.concat(F.array_join(F.transform(x["out"], replaced), ""), text.substr(x["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, _bound(F.aggregate(_chunks(spans), begin, locate), whole)).otherwise(text)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans give one mark."""
    return _rewritten(text, spans, lambda _, overlaps: F.when(overlaps, F.lit("")).otherwise(F.lit(mark)))
