"""Forms of literal assignments that the lexer reads, one by one."""

import time

import pytest

from stowage.llm import secret_scan

KEY = "k9$Lq2!zPw7"
FORMS = {
    "python type": f'password: str = "{KEY}"',
    "python generic type": f'db_password: Optional[str] = "{KEY}"',
    "python union type": f'db_password: str | None = "{KEY}"',
    "scala type": f'val dbPwd: String = "{KEY}"',
    "typescript type": f'apiKey: string = "{KEY}"',
    "typescript optional": f'apiKey?: string = "{KEY}"',
    "rust type": f'let secret: &\'static str = "{KEY}";',
    "name in the place of a type": f'config: password = "{KEY}"',
    "bytes": f'SECRET_KEY = b"{KEY}"',
    "raw": f"SECRET_KEY = r'{KEY}'",
    "formatted": f'SECRET_KEY = f"{KEY}"',
    "raw bytes": f'SECRET_KEY = rb"{KEY}"',
    "verbatim": f'secretKey = @"{KEY}";',
    "verbatim with backslash": f'secretKey = @"{KEY}\\"; x = "other"',
    "interpolated": f'secretKey = $@"{KEY}";',
    "rust raw": f'secret_key = r#"{KEY}"#;',
    "triple double": f'password = """{KEY}"""',
    "triple single": f"password = '''{KEY}'''",
    "typed triple": f'password: str = """{KEY}"""',
    "parentheses": f'password = ("{KEY}")',
    "parentheses over lines": f'password = (\n    b"{KEY}"\n)',
    "flag": f"run --db-pwd={KEY} x",
    "flag with dashes": f"run --private-key={KEY}",
    "quoted flag": f'["run", "--db-pwd={KEY}"]',
    "short flag": f"run -pwd={KEY}",
    "property": f"java -DsecretKey={KEY} Main",
    "upper property": f"cmake -DSECRET_KEY={KEY} .",
}


def named(text):
    return [text[a:b] for kind, a, b in secret_scan.spans_of(text) if kind == "named"]


@pytest.mark.parametrize("form", FORMS)
def test_form(form):
    found = named(FORMS[form])
    assert found == [KEY + "\\"] if "backslash" in form else found == [KEY]
    assert KEY not in secret_scan.redact(FORMS[form])


def test_parts_in_parentheses():
    assert named(f'password = ("{KEY}"\n  "MoreTail99" +\n  "LastPart77")') == [KEY, "MoreTail99", "LastPart77"]
    assert named(f'password = "{KEY}" + b"MoreTail99"') == [KEY, "MoreTail99"]


def test_triple_over_lines():
    assert named(f'private_key = """\n{KEY}\nMoreTail99"""; other = "words"') == [f"\n{KEY}\nMoreTail99"]


def test_no_literal_no_type():
    assert named('note: str = "hello there"') == []
    assert named("password: str = other") == []


@pytest.mark.parametrize("unit", ['a="""', "a: b[", "a: b|c|d = (", "a: b<", "--a", "-D", "a = (", 'a=("b" ', "a=b'", '"""\\', "a: b = r#"])
def test_linear(unit):
    start = time.process_time()
    secret_scan.spans_of(unit * 40000)
    secret_scan.spans_of("=" + unit * 40000)
    assert time.process_time() - start < 10
