"""JSON text as Column expressions that leave untouched values exactly as they were written.

``from_json`` + ``to_json`` re-renders what it reads (``1.50`` becomes ``1.5``, nested keys are sorted), which is not
acceptable for a masking job. Here the commas and colons of the outermost level are marked with control characters,
which no JSON text may hold; pairs and elements are then a split at the marks. Where the nesting is shallow one pattern
checks the grammar and finds the marks. Where it is deeper a parser checks the grammar, and a pattern that only counts
brackets finds the marks. Where that ends too, the text is cut into brackets and what stands between them, and a
fold over these counts what is open, at any depth; it goes by blocks, so its cost grows with the text. All of it runs
in the JVM.

Masking fails closed: a text that is not JSON but looks like it and may hold a name whose value is to go becomes NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- the grammar ---------------------------------------------------------------------------------------------
#
# Loops over groups are possessive: such loops need no stack, however long the text.

_GAP = r"[ \t\n\r]*+"
_STRING = r'"(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+"
_SCALAR = f"(?:{_STRING}|{_NUMBER}|true|false|null){_GAP}"
_KEY = f"{_STRING}{_GAP}:{_GAP}"
#: A bracket, what stands between two of them, or a quote that nothing closes.
_PARTS = r'(?s)(?:[^"\[\]{}]++|"(?:[^"\\]++|\\.)*+")++|[\[\]{}]|.'


def _between() -> str:
    """What may stand between two brackets: the container it is in (. for none), whether the bracket before it opens
    or closes, the text, whether the bracket after it opens or closes."""
    pair, comma = _KEY + _SCALAR, "," + _GAP
    cases = [r"\.s" + _GAP + "o"]
    for container, key, entry in ((r"\{", _KEY, pair), (r"\[", "", _SCALAR)):
        cases += [
            f"{container}o{_GAP}(?:{entry}(?:{comma}{entry})*+)?+c",
            f"{container}o{_GAP}(?:{entry}{comma})*+{key}o",
            f"{container}c{_GAP}(?:{comma}{entry})*+c",
            f"{container}c{_GAP}{comma}(?:{entry}{comma})*+{key}o",
        ]
    return "^(?:" + "|".join(cases) + r")\z"


def _shallow(deepest: int) -> str:
    """A value of so many levels at most."""
    value = _SCALAR
    for _ in range(deepest):
        pairs = rf"\{{{_GAP}(?:{_KEY}{value}(?:,{_GAP}(?=\")|(?=\}})))*+\}}{_GAP}"
        entries = rf"\[{_GAP}(?:{value}(?:,{_GAP}(?!\])|(?=\])))*+\]{_GAP}"
        value = f"(?:{_SCALAR}|{pairs}|{entries})"
    return value


#: Levels that a pattern goes into; deeper texts are folded.
_LEVELS = 4
_SHALLOW = f"^{_GAP}{_shallow(_LEVELS)}\\z"
_SHALLOW_OBJECT = rf"^{_GAP}\{{(?:{_GAP}{_KEY}{_shallow(_LEVELS - 1)}(?:,|(?=\}})))*+{_GAP}(?<!,)\}}{_GAP}\z"


def _unit(deepest: int) -> str:
    """A container of so many levels at most, in a text that is known to be JSON."""
    unit, plain = "", r'[^"\[\]{}]++|"(?:[^"\\]++|\\.)*+"'
    for _ in range(deepest):
        unit = rf"[\[{{](?:{plain}{unit and '|'}{unit})*+[\]}}]"
    return unit


#: Levels that a pattern counts in a text that is known to be JSON; each takes stack, so deeper ones are folded.
_NESTED = 200


def _entries(opening: str, key: str, closing: str) -> str:
    """Group 1: one entry of a container after the other, then an empty one if the pattern came to the container's end."""
    value = rf'(?:"(?:[^"\\]++|\\.)*+"|[^\s,:"\[\]{{}}]++|{_unit(_NESTED)})'
    return rf"(?s)\G(?:(?:^{opening}|,){_GAP}({key}{value}){_GAP}|(?:^{opening}{_GAP})?{closing}\z)"


_ELEMENTS = _entries(r"\[", "", r"\]")
_PAIRS = _entries(r"\{", rf'"(?:[^"\\]++|\\.)*+"{_GAP}:{_GAP}', r"\}")
#: Group 1: the raw key, group 2: the raw value of one pair.
_ONE_PAIR = rf'(?s)^"((?:[^"\\]++|\\.)*+)"{_GAP}:{_GAP}(.*)'

#: Group 1: the raw key, group 2: the raw value of an outermost pair.
_PAIR = rf'(?s)"((?:[^"\\]++|\\.)*+)"{_GAP}:{_GAP}("(?:[^"\\]++|\\.)*+"|[^\s,"\[\]{{}}]++|{_unit(_LEVELS - 1)})'
_WORDS = r'"(?:[^"\\]++|\\.)*+"|[,:]|[^\s,:"\[\]{}]++'
#: What stands before a row of brackets that all open or all close, with them.
_RUNS = r'(?s)(?:[^"\[\]{}]++|"(?:[^"\\]++|\\.)*+")*+(?:[\[{]++|[\]}]++)'

_BETWEEN = _between()
_ALONE = f"^{_GAP}{_SCALAR}\\z"
#: The marks of the outermost level: between entries, between a key and its value.
_NEXT, _COLON = "\x01", "\x02"
#: Parts of one block of the fold.
_BLOCK = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it several times in ``body``: the lambda of a one-element array is the binding."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _marked(part: Column) -> Column:
    """The outermost level's text between two brackets, without white space and with its marks."""
    return _with_marks(F.regexp_extract_all(part, F.lit(_WORDS), F.lit(0)))


def _with_marks(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.when(w == ",", _NEXT).when(w == ":", _COLON).otherwise(w)), "")


def _blocks(parts: Column) -> Column:
    last = F.greatest(F.size(parts) - F.lit(1), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last, F.lit(_BLOCK)), lambda i: F.slice(parts, i + F.lit(1), F.lit(_BLOCK)))


def _parses(text: Column) -> Column:
    """Whether the parser takes the text as one value. It does not look behind a value's end, so the text has to fit
    into an array and into an object. It also refuses repeated keys and very deep texts, which are JSON."""
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    return alone & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()


def _deep_level(text: Column) -> Column:
    """:func:`outer_level` of a text that is known to be JSON: only the depth is counted."""

    def state(depth: Column, out: Column) -> Column:
        return F.struct(depth.alias("depth"), out.alias("out"))

    def step(s: Column, run: Column) -> Column:
        def placed(before: Column) -> Column:
            brackets = F.length(run) - F.length(before)
            depth = s["depth"] + F.when(F.substring(run, -1, 1).isin("{", "["), brackets).otherwise(-brackets)
            chain = F.right(run, brackets)
            text_before = F.when(s["depth"] == 1, F.concat(_marked(before), chain)).when(s["depth"] == 0, chain).otherwise(run)
            return state(depth, F.concat(s["out"], text_before))

        return let(F.rtrim(run, F.lit("[]{}")), placed)

    def block(s: Column, runs: Column) -> Column:
        after = lambda n: F.struct(n["depth"].alias("depth"), F.concat(s["outs"], F.array(n["out"])).alias("outs"))
        return let(F.aggregate(runs, state(s["depth"], F.lit("")), step), after)

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("outs"))
    folded = lambda runs: F.aggregate(_blocks(runs), start, block, lambda s: F.array_join(s["outs"], ""))
    bare = F.trim(text, F.lit(" \t\n\r"))
    return F.when(F.substring(bare, 1, 1).isin("{", "["), let(F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0)), folded)).otherwise(bare)


def _shallow_level(text: Column) -> Column:
    """:func:`outer_level` of a text that is known to be JSON of few levels."""
    words = F.lit(f"(?s){_WORDS}|{_unit(_LEVELS - 1)}")

    def marked(bare: Column) -> Column:
        inner = F.substring(bare, F.lit(2), F.length(bare) - F.lit(2))
        return F.concat(F.substring(bare, 1, 1), _with_marks(F.regexp_extract_all(inner, words, F.lit(0))), F.substring(bare, -1, 1))

    return let(F.trim(text, F.lit(" \t\n\r")), lambda bare: F.when(F.substring(bare, 1, 1).isin("{", "["), marked(bare)).otherwise(bare))


def outer_level(text: Column, known: bool = False) -> Column:
    """The text with its outermost commas and colons as marks and without white space around them; NULL for what is
    not one JSON value. What lies deeper keeps its text. ``known``: the text is part of one that was checked."""
    deep = _deep_level(text) if known else F.when(_parses(text), _deep_level(text)).otherwise(_checked_level(text))
    return F.when(text.rlike(_SHALLOW), _shallow_level(text)).otherwise(deep)


def _checked_level(text: Column) -> Column:
    """:func:`outer_level` by a fold that knows the whole grammar."""

    def state(stack: Column, before: Column, part: Column, out: Column, fits: Column) -> Column:
        return F.struct(stack.alias("stack"), before.alias("before"), part.alias("part"), out.alias("out"), fits.alias("fits"))

    def step(s: Column, part: Column) -> Column:
        opens = part.isin("{", "[")
        inside = F.when(s["stack"] == "", ".").otherwise(F.right(s["stack"], F.lit(1)))
        side = F.when(opens, "o").otherwise("c")
        closed = opens | (F.when(part == "}", "{").otherwise("[") == inside)
        fits = s["fits"] & closed & F.concat(inside, s["before"], s["part"], side).rlike(_BETWEEN)
        stack = F.when(opens, F.concat(s["stack"], part)).otherwise(F.substring(s["stack"], F.lit(1), F.length(s["stack"]) - F.lit(1)))
        own = F.when((s["part"] != "") & (F.length(s["stack"]) == 1), _marked(s["part"])).when(s["stack"] == "", "").otherwise(s["part"])
        bracket = state(stack, side, F.lit(""), F.concat(s["out"], own, part), fits)
        other = state(s["stack"], s["before"], part, s["out"], s["fits"] & (part != '"'))
        return F.when(part.isin("{", "[", "}", "]"), bracket).otherwise(other)

    def block(s: Column, parts: Column) -> Column:
        start = state(s["stack"], s["before"], s["part"], F.lit(""), s["fits"])

        def after(n: Column) -> Column:
            return F.struct(n["stack"].alias("stack"), n["before"].alias("before"), n["part"].alias("part"), F.concat(s["outs"], F.array(n["out"])).alias("outs"), n["fits"].alias("fits"))

        return let(F.aggregate(parts, start, step), after)

    def whole(s: Column) -> Column:
        closed = (s["before"] == "c") & s["part"].rlike(f"^{_GAP}\\z")
        alone = (s["before"] == "s") & s["part"].rlike(_ALONE)
        return F.when(s["fits"] & (s["stack"] == ""), F.when(closed, F.array_join(s["outs"], "")).when(alone, F.trim(s["part"], F.lit(" \t\n\r"))))

    def folded(parts: Column) -> Column:
        none = F.lit("")
        start = F.struct(none.alias("stack"), F.lit("s").alias("before"), none.alias("part"), F.array().cast("array<string>").alias("outs"), F.lit(True).alias("fits"))
        return F.aggregate(_blocks(parts), start, block, whole)

    return let(F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0)), folded)


def _inside(level: Column) -> Column:
    """Entries of the outermost level of an object or array."""
    inner = F.substring(level, F.lit(2), F.length(level) - F.lit(2))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _NEXT))


def _is(level: Column, bracket: str) -> Column:
    return F.coalesce(F.startswith(level, F.lit(bracket)), F.lit(False))


def _unescape(raw: Column) -> Column:
    """Inner text of a JSON string -> the string it stands for; only escaped text pays for a parse."""
    parsed = F.get(F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>"), F.lit(0))
    return F.when(F.contains(raw, F.lit("\\")), parsed).otherwise(raw)


def _pairs(level: Column) -> Column:
    def pair(entry: Column) -> Column:
        def parts(p: Column) -> Column:
            raw = F.substring(p[0], F.lit(2), F.length(p[0]) - F.lit(2))
            return F.struct(raw.alias("raw"), _unescape(raw).alias("key"), p[1].alias("value"))

        return let(F.split(entry, _COLON), parts)

    return F.transform(_inside(level), pair)


def _shallow_pairs(text: Column) -> Column:
    """Pairs of an object that :data:`_SHALLOW_OBJECT` has checked, without marks."""
    found = lambda group: F.regexp_extract_all(text, F.lit(_PAIR), F.lit(group))
    return F.zip_with(found(1), found(2), lambda raw, value: F.struct(raw.alias("raw"), _unescape(raw).alias("key"), value.alias("value")))


def _nested_entries(text: Column, entries: str, known: bool) -> Column:
    """Entries of a container of :data:`_NESTED` levels at most; NULL for any other text.

    If the pattern came to the end, no bracket before the last one closes the first one. So a parser that takes the text,
    and does not look behind the value's end, has taken all of it."""

    def found(bare: Column) -> Column:
        def checked(e: Column) -> Column:
            reached = F.get(e, F.size(e) - F.lit(1)) == ""
            whole = reached if known else reached & F.try_parse_json(bare).isNotNull()
            return F.when(whole, F.slice(e, F.lit(1), F.size(e) - F.lit(1)))

        return let(F.regexp_extract_all(bare, F.lit(entries), F.lit(1)), checked)

    return let(F.trim(text, F.lit(" \t\n\r")), found)


def _nested_pairs(text: Column, known: bool) -> Column:
    def pair(entry: Column) -> Column:
        part = lambda group: F.regexp_extract(entry, _ONE_PAIR, group)
        return let(part(1), lambda raw: F.struct(raw.alias("raw"), _unescape(raw).alias("key"), part(2).alias("value")))

    return F.transform(_nested_entries(text, _PAIRS, known), pair)


def by_pairs(text: Column, pairs: Callable[[Column], Column], broken: Column, other: Column, known: bool = False) -> Column:
    """``pairs`` of the outermost pairs of an object; for what is not JSON ``broken``, for other values ``other``."""
    no_object = F.array(F.lit(None).cast("struct<raw:string,key:string,value:string>"))
    deeper = let(outer_level(text, known), lambda level: F.when(_is(level, "{"), _pairs(level)).when(level.isNotNull(), no_object))
    found = F.when(text.rlike(_SHALLOW_OBJECT), _shallow_pairs(text)).otherwise(let(_nested_pairs(text, known), lambda p: F.coalesce(p, deeper)))
    # An object's pairs are never null, so a null one says that there is none.
    return let(found, lambda p: F.when(p.isNull(), broken).when((F.size(p) == 1) & F.get(p, F.lit(0)).isNull(), other).otherwise(pairs(p)))


def object_pairs(text: Column) -> Column:
    """Top-level pairs of a JSON object: ``array<struct<raw key text, key, raw value text>>``.

    Anything that is not an object (NULL, empty, broken, an array) has no pairs.
    """
    none = F.array().cast("array<struct<raw:string,key:string,value:string>>")
    return by_pairs(text, lambda p: p, none, none)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A long expression in a plain projection is copied into every filter and projection above it, which makes plans
    explode.  A one-element ``inline`` is a step of its own that nothing is merged into.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _names(names: Column | Sequence[str]) -> Column:
    return names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _may_hold(text: Column, names: Column) -> Column:
    """False only if no key of the text is one of the names: they are not in it, and nothing in it is escaped."""
    return F.contains(text, F.lit("\\")) | F.exists(names, lambda n: F.contains(text, n))


def _rendered(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(F.lit('"'), p["raw"], F.lit('":'), p["value"])), ","), F.lit("}"))


def _was_meant(text: Column) -> Column:
    """Whether a text that is not JSON has a quote, colon or bracket, so that the name in it may be a key. Prose is not."""
    return text.rlike(r"""["':{\[]""")


def _closed(text: Column) -> Column:
    """What becomes of a text that is not JSON and may hold a name."""
    return F.when(~_was_meant(text), text)


def _values(value: Column) -> Column:
    """The elements of an array; any other value alone."""
    deeper = let(outer_level(value, known=True), _inside)
    elements = let(_nested_entries(value, _ELEMENTS, known=True), lambda e: F.coalesce(e, deeper))
    return F.when(_is(value, "["), elements).otherwise(F.array(value))


def _without(text: Column, names: Column, known: bool = False) -> Column:
    def cut(pairs: Column) -> Column:
        kept = F.filter(pairs, lambda p: ~F.array_contains(names, p["key"]))
        return let(kept, lambda k: F.when(F.size(k) == F.size(pairs), text).otherwise(_rendered(k)))

    return F.when(_may_hold(text, names), by_pairs(text, cut, _closed(text), text, known)).otherwise(text)


def drop_keys(text: Column, names: Column | Sequence[str]) -> Column:
    """Remove top-level keys.  With nothing to remove the original text comes back, spaces included."""
    return let(text, lambda t: _without(t, F.coalesce(_names(names), F.array().cast("array<string>"))))


def path_array(paths: Sequence[tuple[str, str]]) -> Column:
    """A constant ``array<struct<class,field>>`` for :func:`drop_paths`."""
    return F.array(*[F.struct(F.lit(c).alias("class"), F.lit(f).alias("field")) for c, f in paths])


def _fields_of(paths: Column, key: Column) -> Column:
    """Field names of one class."""
    return F.transform(F.filter(paths, lambda p: p["class"] == key), lambda p: p["field"])


def _all_fields(paths: Column) -> Column:
    return F.transform(paths, lambda p: p["field"])


def drop_paths(text: Column, paths: Column) -> Column:
    """Remove ``class.field`` for every path, in an object or in each object of an array.

    ``paths`` is ``array<struct<class,field>>``, constant or per row.  Deeper paths are left alone, and a
    text without any of the classes comes back unchanged.
    """

    def cleaned(value: Column, fields: Column) -> Column:
        done = F.transform(_values(value), lambda e: _without(e, fields, known=True))
        return let(done, lambda d: F.when(_is(value, "["), F.concat(F.lit("["), F.array_join(d, ","), F.lit("]"))).otherwise(F.get(d, F.lit(0))))

    def cut(whole: Column) -> Callable[[Column], Column]:
        def pair(p: Column) -> Column:
            value = let(_fields_of(paths, p["key"]), lambda f: F.when(F.size(f) == 0, p["value"]).otherwise(cleaned(p["value"], f)))
            return F.struct(p["raw"].alias("raw"), p["key"].alias("key"), value.alias("value"))

        known = lambda pairs: F.exists(pairs, lambda p: F.exists(paths, lambda r: r["class"] == p["key"]))
        return lambda pairs: F.when(known(pairs), _rendered(F.transform(pairs, pair))).otherwise(whole)

    return let(text, lambda t: F.when(_may_hold(t, _all_fields(paths)), by_pairs(t, cut(t), _closed(t), t)).otherwise(t))


def has_path(text: Column, paths: Column) -> Column:
    """True while any ``class.field`` is still present, in an object or in an element of an array, and for a text
    that is not JSON and may hold one of the fields."""
    no = F.lit(False)

    def holds(value: Column, fields: Column) -> Column:
        return by_pairs(value, lambda pairs: F.exists(pairs, lambda p: F.array_contains(fields, p["key"])), no, no, known=True)

    def left(p: Column, fields: Column) -> Column:
        inside = F.exists(_values(p["value"]), lambda e: F.when(_may_hold(e, fields), holds(e, fields)).otherwise(no))
        return F.when((F.size(fields) > 0) & _may_hold(p["value"], fields), inside).otherwise(no)

    def found(pairs: Column) -> Column:
        return F.exists(pairs, lambda p: let(_fields_of(paths, p["key"]), lambda f: left(p, f)))

    return let(text, lambda t: F.coalesce(F.when(_may_hold(t, _all_fields(paths)), by_pairs(t, found, _was_meant(t), no)), no))


def skip_path(text: Column, steps: Sequence[str]) -> Column:
    """Remove one object path of any depth, the same for every row; arrays and encoded strings are not entered."""

    def skipped(value: Column, rest: Sequence[str], known: bool) -> Column:
        if len(rest) == 1:
            return _without(value, _names(rest), known)

        def pair(p: Column) -> Column:
            deeper = F.when(p["key"] == rest[0], skipped(p["value"], rest[1:], True)).otherwise(p["value"])
            return F.struct(p["raw"].alias("raw"), p["key"].alias("key"), deeper.alias("value"))

        def cut(pairs: Column) -> Column:
            return F.when(F.exists(pairs, lambda p: p["key"] == rest[0]), _rendered(F.transform(pairs, pair))).otherwise(value)

        return by_pairs(value, cut, _closed(value), value, known)

    path = list(steps)
    if not path:
        return text
    return let(text, lambda t: F.when(_may_hold(t, _names(path[-1:])), skipped(t, path, False)).otherwise(t))


# --- values set to null at any depth -----------------------------------------------------------------------------
#
# A text may hold JSON in its strings, and that may again. Each time, a quote gets a longer run of backslashes: r of
# them become 2 r + 1. In the patterns group 2 is the run of the key's own quotes.


def _spelled(name: Column) -> Column:
    """Pattern of a key's text: each character as it is or escaped."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit(r"\2\\u(?i:"), F.lpad(F.hex(code), 4, "0"), F.lit(")"))

    def character(c: Column) -> Column:
        code = F.ascii(c)
        high = (F.shiftright(code - F.lit(0x10000), 10) + F.lit(0xD800)).cast("int")
        low = (code - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF)) + F.lit(0xDC00)
        short = F.create_map(*[F.lit(x) for pair in {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}.items() for x in pair])
        plain = (
            F.when(c == '"', F.lit(r"\2\2\\\x22"))
            .when(c == "\\", F.lit(r"\2\2\\\\"))
            .when(c == "/", F.lit(r"(?:\2\\)?/"))
            .when(short[code].isNotNull(), F.concat(F.lit(r"\2\\"), short[code]))
            .otherwise(F.concat(F.lit(r"\x{"), F.hex(code), F.lit("}")))
        )
        escaped = F.when(code >= F.lit(0x10000), F.concat(unit(high), unit(low))).otherwise(unit(code))
        return F.concat(F.lit("(?:"), plain, F.lit("|"), escaped, F.lit(")"))

    return F.array_join(F.transform(F.split(name, ""), character), "")


_SPACES = r"(?:\s|\\++[nrt])*+"
_ENDS = r"(?:\2\2\\\\)*+\2\x22"
_QUOTED = rf"\2\x22(?:[^\x22\\]++|\\++(?!\x22)|(?!{_ENDS})\\*+\x22)*+{_ENDS}"
_PLAIN = r"-?[0-9][0-9.eE+\-]*+|true|false"


def _key_pattern(names: Column) -> Column:
    """Group 1: a key of these names with its colon, at any depth and in JSON that stands in strings."""
    every = F.array_join(F.transform(names, _spelled), "|")
    return F.concat(F.lit(r"((?<=[{,\s]|\\[nrt])(\\*+)\x22(?:"), every, F.lit(rf")\2\x22{_SPACES}:{_SPACES})"))


def _without_containers(text: Column, key: Column) -> Column:
    """The text with the objects and arrays of these keys set to null.

    A fold over quotes with their backslashes, brackets and the rest; from such a key on nothing is kept until its
    bracket closes. Only quotes of the key's own run open or end strings on the way.
    """
    parts = F.regexp_extract_all(text, F.concat(F.lit("(?s)"), key, F.lit(r'(?=[{\[])|\\*+"|[{}\[\]]|[^"\\{}\[\]]++|\\++(?!")')), F.lit(0))

    def state(run: Column, depth: Column, quoted: Column, out: Column) -> Column:
        return F.struct(run.alias("run"), depth.alias("depth"), quoted.alias("quoted"), out.alias("out"))

    def step(s: Column, p: Column) -> Column:
        is_key = F.contains(p, F.lit('"')) & ~F.endswith(p, F.lit('"'))
        run = F.length(p) - F.lit(1)  # of a quote
        bare = F.when(is_key, F.instr(p, '"') - F.lit(1)).otherwise(F.lit(0))
        idle = F.when(is_key, state(bare, F.lit(0), F.lit(False), F.concat(s["out"], p, F.lit("null")))).otherwise(state(s["run"], s["depth"], s["quoted"], F.concat(s["out"], p)))
        ends = F.pmod(run - s["run"], F.lit(2) * s["run"] + F.lit(2)) == 0
        flips = F.endswith(p, F.lit('"')) & F.when(s["quoted"], ends).otherwise(run == s["run"])
        depth = s["depth"] + F.when(s["quoted"], 0).when(p.isin("{", "["), 1).when(p.isin("}", "]"), -1).otherwise(0)
        gone = state(F.when((depth == 0) & p.isin("}", "]") & ~s["quoted"], F.lit(-1)).otherwise(s["run"]), depth, s["quoted"] != flips, s["out"])
        return F.when(s["run"] < 0, idle).otherwise(gone)

    def block(s: Column, some: Column) -> Column:
        def after(n: Column) -> Column:
            return F.struct(n["run"].alias("run"), n["depth"].alias("depth"), n["quoted"].alias("quoted"), F.concat(s["outs"], F.array(n["out"])).alias("outs"))

        return let(F.aggregate(some, state(s["run"], s["depth"], s["quoted"], F.lit("")), step), after)

    def folded(all_parts: Column) -> Column:
        start = F.struct(F.lit(-1).alias("run"), F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.array().cast("array<string>").alias("outs"))
        return F.aggregate(_blocks(all_parts), start, block, lambda s: F.array_join(s["outs"], ""))

    return let(parts, folded)


def null_values(text: Column, names: Column | Sequence[str]) -> Column:
    """Set the values of these keys to null wherever they stand, also nested ones and in string-encoded JSON.

    Inside a string, a key of these names with a value counts even where the rest of the string is not JSON.
    """

    def by_key(key: Column) -> Column:
        scalars = F.regexp_replace(text, F.concat(key, F.lit(rf"(?:{_QUOTED}|{_PLAIN})")), F.lit("$1null"))
        return let(scalars, lambda t: F.when(F.regexp_like(t, F.concat(key, F.lit(r"[{\[]"))), _without_containers(t, key)).otherwise(t))

    def nulled(own: Column) -> Column:
        valid = text.rlike(_SHALLOW) | _parses(text) | _checked_level(text).isNotNull()
        return F.when(~_may_hold(text, own) | (F.size(own) == 0), text).when(valid, let(_key_pattern(own), by_key)).otherwise(_closed(text))

    return let(F.coalesce(_names(names), F.array().cast("array<string>")), nulled)


def scalar_text(value: Column) -> Column:
    """Raw JSON value -> text: strings are unquoted, everything else keeps its JSON text."""
    return F.when(
        F.startswith(value, F.lit('"')), _unescape(F.substring(value, F.lit(2), F.length(value) - F.lit(2)))
    ).otherwise(value)


def _as_map(text: Column, value: Callable[[Column], Column]) -> Column:
    """Pairs as a map; of a repeated key the last value counts."""

    def last_of(pairs: Column, keys: Column) -> Column:
        later = lambda i: F.slice(keys, i + F.lit(2), F.size(keys))
        return F.filter(pairs, lambda p, i: ~F.array_contains(later(i), p["key"]))

    def build(pairs: Column) -> Column:
        keys = F.transform(pairs, lambda p: p["key"])
        unique = let(
            keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), pairs).otherwise(last_of(pairs, k))
        )
        return F.map_from_entries(F.transform(unique, lambda p: F.struct(p["key"], value(p["value"]))))

    return let(object_pairs(text), build)


def text_map(text: Column) -> Column:
    """Top-level keys -> values as text (numbers and booleans keep their JSON text)."""
    return _as_map(text, scalar_text)


def value_type(value: Column) -> Column:
    """JSON type name of a raw value."""
    first = F.substring(value, 1, 1)
    return (
        F.when(first == '"', "string")
        .when(first == "{", "object")
        .when(first == "[", "array")
        .when(value.isin("true", "false"), "boolean")
        .when(value == "null", "null")
        .otherwise("number")
    )


def list_paths(df: DataFrame, column: str) -> DataFrame:
    """Every top-level path in the column with the JSON types it was seen with and how often."""
    pairs = df.select(F.explode(object_pairs(F.col(column))).alias("p"))
    return (
        pairs.groupBy(F.col("p.key").alias("path"), value_type(F.col("p.value")).alias("type"))
        .agg(F.count("*").alias("rows"))
        .groupBy("path")
        .agg(F.array_sort(F.collect_set("type")).alias("types"), F.sum("rows").alias("rows"))
    )
