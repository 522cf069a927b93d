"""JSON cutting against a small brute-force remover on generated documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions import json_text as J

NAMES = ["color", "größe", "tel", "a b", "q\"t"]


class Raw(str):
    """A scalar that keeps its own spelling."""


def generated(rng, depth):
    """A document as nested lists and lists of pairs, so that order, repeats and spelling stay."""
    kind = rng.random()
    if depth == 0 or kind < 0.4:
        return Raw(rng.choice(["1.50", "1e3", "-0", "true", "null", '"x"', '"a\\"b,{"', '"\\u00e9]"', '""']))
    if kind < 0.65:
        return [generated(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {i: (rng.choice(NAMES), generated(rng, depth - 1)) for i in range(rng.randrange(5))}


def written(doc):
    if isinstance(doc, Raw):
        return str(doc)
    if isinstance(doc, list):
        return "[" + ",".join(map(written, doc)) + "]"
    return "{" + ",".join(f"{json.dumps(k)}:{written(v)}" for k, v in doc.values()) + "}"


def without(doc, names):
    return {i: p for i, p in doc.items() if p[0] not in names} if isinstance(doc, dict) else doc


def without_paths(doc, fields):
    if not isinstance(doc, dict):
        return doc
    cut = lambda v, f: [without(x, f) for x in v] if isinstance(v, list) else without(v, f)
    return {i: (k, cut(v, fields[k]) if k in fields else v) for i, (k, v) in doc.items()}


def nulled(doc, names):
    if isinstance(doc, list):
        return [nulled(x, names) for x in doc]
    if isinstance(doc, dict):
        return {i: (k, Raw("null") if k in names else nulled(v, names)) for i, (k, v) in doc.items()}
    return doc


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(17)
    return [generated(rng, 6) for _ in range(400)]


def applied(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    return [r.o for r in df.select("i", column(F.col("j")).alias("o")).orderBy("i").collect()]


def test_drop_keys_against_brute_force(spark, documents):
    names = ["tel", "q\"t"]
    got = applied(spark, list(map(written, documents)), lambda c: J.drop_keys(c, names))
    assert got == [written(without(d, names)) for d in documents]


def test_paths_against_brute_force(spark, documents):
    fields = {"color": {"tel", "größe"}, "a b": {"color"}}
    paths = J.path_array([(c, f) for c, fs in fields.items() for f in sorted(fs)])
    texts = list(map(written, documents))
    got = applied(spark, texts, lambda c: J.drop_paths(c, paths))
    assert got == [written(without_paths(d, fields)) for d in documents]
    before, after = applied(spark, texts, lambda c: J.has_path(c, paths)), applied(spark, got, lambda c: J.has_path(c, paths))
    assert before == [g != t for g, t in zip(got, texts)] and any(before) and not any(after)


def test_null_values_against_brute_force(spark, documents):
    names = ["tel", "a b"]
    texts = list(map(written, documents))
    assert applied(spark, texts, lambda c: J.null_values(c, names)) == [written(nulled(d, names)) for d in documents]


def test_null_values_in_encoded_json(spark, documents):
    """A document as a string inside another one, once and twice, spelled in different ways."""
    texts, want = [], []
    for d in documents:
        inner, without = written(d), written(nulled(d, {"tel", "größe", 'q"t'}))
        for ascii_only in (True, False):
            outer, expected = (json.dumps(t, ensure_ascii=ascii_only) for t in (inner, without))
            holder = '{ "body" : %s, "n":1.50 }'
            twice, expected_twice = (json.dumps(holder % t, ensure_ascii=ascii_only) for t in (outer, expected))
            texts += [holder % outer, f"[{twice}]"]
            want += [holder % expected, f"[{expected_twice}]"]
    assert applied(spark, texts, lambda c: J.null_values(c, ["tel", "größe", 'q"t'])) == want


def test_null_values_of_keys_that_need_escapes(spark):
    names = ["a/b", "t\tb", "back\\slash", "smile😀", "tel"]
    docs = [{n: v} for n in names for v in ("x", "\\", '"', 'q"}', [1, ["\\"]], {"z": "]"}, -1.5, True)]
    deep = lambda d, times: d if not times else {"body": json.dumps(deep(d, times - 1))}
    texts = [json.dumps(deep(d, times), indent=indent) for d in docs for times in (0, 1, 3) for indent in (None, 1)]
    want = [deep({n: None for n in d}, times) for d in docs for times in (0, 1, 3) for _ in (None, 1)]
    got = applied(spark, texts, lambda c: J.null_values(c, names))
    assert [json.loads(g) for g in got] == want
    slash = '{"a\\/b":1,"\\u0074\\u0065l":"x","body":"{\\"a\\\\/b\\":{\\"k\\":[\\"}\\"]},\\"n\\":1}"}'
    assert applied(spark, [slash], lambda c: J.null_values(c, names)) == ['{"a\\/b":null,"\\u0074\\u0065l":null,"body":"{\\"a\\\\/b\\":null,\\"n\\":1}"}']


DEPTHS = [1, 2, 15, 60, 200, 3000]
SIDES = [('{"k":', "}"), ("[", "]"), ('[{"k":', "}]")]


def test_no_depth_is_too_deep(spark):
    deep = [left * depth + "1.50" + right * depth for depth in DEPTHS for left, right in SIDES]
    record = '{"user":[{"tel":"010","d":%s,"name":"a"}],"x":{"tel": 1}}'
    paths = J.path_array([("user", "tel")])
    raw = [record % d for d in deep]
    assert all(applied(spark, raw, lambda c: J.has_path(c, paths)))
    out = applied(spark, raw, lambda c: J.drop_paths(c, paths))
    assert out == ['{"user":[{"d":%s,"name":"a"}],"x":{"tel": 1}}' % d for d in deep]
    assert not any(applied(spark, out, lambda c: J.has_path(c, paths)))
    assert applied(spark, ['{"tel":%s,"n":1.50}' % d for d in deep], lambda c: J.drop_keys(c, ["tel"])) == ['{"n":1.50}'] * len(deep)
    got = applied(spark, ['{"p":{"q":%s,"r":%s}}' % (d, d) for d in deep], lambda c: J.skip_path(c, ["p", "q"]))
    assert got == ['{"p":{"r":%s}}' % d for d in deep]
    got = applied(spark, ['{"d":%s,"tel":%s,"z":1}' % (d, d) for d in deep], lambda c: J.null_values(c, ["tel"]))
    assert got == ['{"d":%s,"tel":null,"z":1}' % d for d in deep]


def test_nested_texts_need_no_fold(spark, monkeypatch):
    """Objects and arrays of up to 200 levels are cut by patterns alone; the fold is for deeper ones."""

    def fold(text):
        return F.raise_error(F.lit("folded")).cast("string")

    nested = [left * depth + '"]}\\\\"' + right * depth for depth in (5, 60, 99) for left, right in SIDES]
    record = ' {"user": [{"tel":"010", "d":%s},{ "n":1 }, [{"tel":1}]] ,"t\\u0065l":%s}\n'
    raw, paths = [record % (d, d) for d in nested], J.path_array([("user", "tel")])
    want = ['{"user":[{"d":%s},{ "n":1 },[{"tel":1}]],"t\\u0065l":%s}' % (d, d) for d in nested]
    monkeypatch.setattr(J, "_deep_level", fold)
    monkeypatch.setattr(J, "_checked_level", fold)
    assert applied(spark, raw, lambda c: J.drop_paths(c, paths)) == want
    assert all(applied(spark, raw, lambda c: J.has_path(c, paths))) and not any(applied(spark, want, lambda c: J.has_path(c, paths)))


def test_nested_texts_fail_closed(spark):
    """What a parser that stops at a value's end would take, and what only counts brackets would."""
    d = "[" * 9 + "1" + "]" * 9
    bad = ['{"a":{"tel":%s}}{}', '{"a":{"tel":%s}}]', '{"a":{"tel":%s},}', '{"a":{"tel":%s}', '{"a":{"tel":%s},"b"}', '{"a":{"tel":%s} "b":1}', '{"a":{"tel" %s}}', '{"a":{"tel":%s]}', '{"a":{"tel":[%s}}]', '{"tel":%s}{"tel":1}']
    paths = J.path_array([("a", "tel")])
    for column in (lambda c: J.drop_paths(c, paths), lambda c: J.drop_keys(c, ["tel"])):
        assert applied(spark, [t % d for t in bad], column) == [None] * len(bad)
    assert all(applied(spark, [t % d for t in bad], lambda c: J.has_path(c, paths)))
    twice = '{"a":{"tel":%s,"x":1},"a":{"x":2,"tel":%s}}' % (d, d)
    assert applied(spark, [twice], lambda c: J.drop_paths(c, paths)) == ['{"a":{"x":1},"a":{"x":2}}']


# A text that is not JSON: one that may hold the name does not come through, the others come back.
BROKEN = [
    "{", '{"tel":1', '{"tel" 1}', '{"tel":1,}', '{"tel":1}}', "[1,2", '{"a":[1}', "text", "{tel:1}", '{"tel":}', '{"tel":1}{', '{"tel":1} x', '{"tel":tru}', "{'tel':1}",
    '{"x":1,,"tel":2}', '{"tel":01}', '{"tel":1e+-.5}', '{"tel":"a\nb"}', '{"tel":"\\x"}', '["tel":1]', '{"tel"}', '{"tel":[1,]}', '{"tel":[,1]}', '{"tel":1 2}', '[{"tel":1]}',
    '{"tel":"open', ',{"tel":1}', '{"tel":1}]', '"tel" "tel"', '{"a":{"b":1}"tel":1}', '{"a":{}{"tel":1}}', '{"t\\u0065l":1',
]


def test_what_is_not_json_fails_closed(spark):
    want = [None if "tel" in t or "\\" in t else t for t in BROKEN]
    paths = J.path_array([("a", "tel")])
    for column in (lambda c: J.drop_keys(c, ["tel"]), lambda c: J.drop_paths(c, paths), lambda c: J.skip_path(c, ["a", "tel"]), lambda c: J.null_values(c, ["tel"])):
        assert applied(spark, BROKEN, column) == want
    assert applied(spark, BROKEN, lambda c: J.has_path(c, paths)) == [w is None for w in want]
    assert applied(spark, BROKEN, J.object_pairs) == [[] for _ in BROKEN]


WHOLE = ["", "   ", None, "1", " null ", '"tel"', "[]", "{}", '["tel"]', "-0", "1E+2", '{"x":{"tel":[]}}', " [ { } , [ ] ] ", '{"":"tel"}', '[{"tel":1}]']


def test_json_without_the_key_comes_back(spark):
    for column in (lambda c: J.drop_keys(c, ["tel"]), lambda c: J.drop_paths(c, J.path_array([("a", "tel")])), lambda c: J.skip_path(c, ["a", "tel"])):
        assert applied(spark, WHOLE, column) == WHOLE
    assert not any(applied(spark, WHOLE, lambda c: J.has_path(c, J.path_array([("a", "tel")]))))


def test_grammar_against_the_parser(spark):
    """What counts as JSON, on texts with a few characters changed."""
    rng = random.Random(5)
    texts = []
    for _ in range(4000):
        t = written(generated(rng, 3))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(t) + 1)
            t = t[:i] + rng.choice(["", "{", "}", "[", "]", ",", ":", '"', " ", "\\", "1", "e"]) + t[i + rng.randrange(2) :]
        texts.append(t)

    def parses(t):
        try:
            json.loads(t, parse_constant=lambda c: 1 / 0)
        except (ValueError, ZeroDivisionError):
            return False
        return True

    got = applied(spark, texts, lambda c: J.outer_level(c).isNotNull())
    assert got == [parses(t) for t in texts] and 500 < sum(got) < 3500


def test_long_texts_go_by_blocks(spark):
    """Thousands of objects to cut in one text, and one object with thousands of keys."""
    people = [{"tel": str(i), "n": i} for i in range(20_000)]
    text = json.dumps({"user": people}, separators=(",", ":"))
    want = json.dumps({"user": [{"n": p["n"]} for p in people]}, separators=(",", ":"))
    assert applied(spark, [text], lambda c: J.drop_paths(c, J.path_array([("user", "tel")]))) == [want]
    wide = json.dumps({f"k{i}": {"a": i} for i in range(5000)}, separators=(",", ":"))
    assert applied(spark, [wide], lambda c: F.size(J.object_pairs(c))) == [5000]
    nulls = json.dumps({"user": [{"tel": {"z": [i]}} for i in range(3000)]}, separators=(",", ":"))
    assert applied(spark, [nulls], lambda c: J.null_values(c, ["tel"])) == ['{"user":[' + ",".join(['{"tel":null}'] * 3000) + "]}"]


def test_spelling_of_what_stays(spark):
    cases = [
        ('{ "n" : 1.50 }', '{ "n" : 1.50 }'),
        ('{ "tel" : "1" , "n" : 1e3 }', '{"n":1e3}'),
        ('{"t\\u0065l":"1","n":[1, 2]}', '{"n":[1, 2]}'),
        ('{"tel":"1"}', "{}"),
        ('{"tel":1,"tel":2,"in":{"tel":3}}', '{"in":{"tel":3}}'),
    ]
    assert applied(spark, [c[0] for c in cases], lambda c: J.drop_keys(c, ["tel"])) == [c[1] for c in cases]


def test_long_values_do_not_overflow(spark):
    big = json.dumps({"tel": "x" * 200_000, "list": list(range(20_000)), "y": "a\\\"b" * 30_000}, separators=(",", ":"))
    (out,) = applied(spark, [big], lambda c: J.drop_keys(c, ["tel"]))
    assert json.loads(out) == {k: v for k, v in json.loads(big).items() if k != "tel"}


def test_maps_and_paths(spark):
    df = spark.createDataFrame([("a", '{"n":1,"s":"x\\n","b":true,"o":{"k":1}}'), ("b", '{"n":"1","z":null,"z":2}')], "name string, j string")
    m = df.orderBy("name").select(J.text_map(F.col("j")).alias("m")).collect()
    assert m[0].m == {"n": "1", "s": "x\n", "b": "true", "o": '{"k":1}'}
    assert m[1].m == {"n": "1", "z": "2"}
    paths = {r.path: r.types for r in J.list_paths(df, "j").collect()}
    assert paths == {"n": ["number", "string"], "s": ["string"], "b": ["boolean"], "o": ["object"], "z": ["null", "number"]}
