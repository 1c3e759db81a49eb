import pytest
from helpers import frame

from corpusloom.operators import sections as S


def response(instruction="do", html="<a/>", js="export default class Big {}", css="=== CSS ===\nNONE"):
    return f"<think>=== JS ===</think>\n=== INSTRUCTION ===\n{instruction}\n\n=== HTML ===\n{html}\n=== JS ===\n{js}\n{css}"


CASES = {
    "plain": (response(), "<!-- big.html -->\n<a/>\n\n// big.js\nexport default class Big {}"),
    "css": (response(css="=== CSS ===\n```css\n:host{}\n```"),
            "<!-- big.html -->\n<a/>\n\n// big.js\nexport default class Big {}\n\n/* big.css */\n:host{}"),
    "no css marker": (response(css=""), "<!-- big.html -->\n<a/>\n\n// big.js\nexport default class Big {}"),
    "fences": (response(html="```html\n<a/>\n```", js="```javascript\nlet a;\n```\n"), "<!-- myComponent.html -->\n<a/>\n\n// myComponent.js\nlet a;"),
    "inner fences": (response(js="let a;\n```js\nlet b;\n```\nlet c;"), "<!-- myComponent.html -->\n<a/>\n\n// myComponent.js\nlet a;\nlet b;\nlet c;"),
    "described": (response(js="describe('c-form2x-list', f)"), "<!-- form2XList.html -->\n<a/>\n\n// form2XList.js\ndescribe('c-form2x-list', f)"),
    "tag without letters": (response(js="describe('c--_', f)"), None),
    "unicode": (response(js="export default class Été {}"), "<!-- été.html -->\n<a/>\n\n// été.js\nexport default class Été {}"),
    "empty html": (response(html=""), "<!-- big.html -->\n\n\n// big.js\nexport default class Big {}"),
    "no html": ("=== INSTRUCTION ===\nx\n=== JS ===\ny", None),
    "wrong order": ("=== HTML ===\nx\n=== JS ===\ny\n=== INSTRUCTION ===\nz", None),
    "nothing": ("", None),
}


def test_lenient(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "name string, raw string")
    got = {r["name"]: r["example"] and r["example"]["output"] for r in S.section_attempts(df).collect()}
    assert got == {k: v[1] for k, v in CASES.items()}


def test_strict_wants_the_css_marker(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "name string, raw string")
    got = {r["name"]: r["example"] for r in S.section_attempts(df, mode="strict").collect()}
    assert got["no css marker"] is None
    assert got["described"]["name"] == "GraphqlComponent"
    # CSS keeps its fence here
    assert got["css"]["output"].endswith("/* big.css */\n```css\n:host{}\n```")


@pytest.mark.parametrize("text, want", [
    ("```html\na\n```", "a"), ("a", "a"), ("```\na\n```\n```", "a"), ("``````", ""), ("x ```", "x"), ("```ts\na\n```", "ts\na"),
])
def test_fences(spark, text, want):
    df = frame(spark, "a string, b string", (text, "other"))
    assert tuple(S.strip_fences(df, "a", "b").first()) == (want, "other")


def test_empty_sections_match(spark):
    raw = "=== INSTRUCTION ===\n=== HTML ===\n=== JS ===\n=== CSS ==="
    row = S.section_attempts(frame(spark, "raw string", (raw,)), mode="strict").first()
    assert row["example"]["output"] == "<!-- graphqlComponent.html -->\n\n\n// graphqlComponent.js\n"
