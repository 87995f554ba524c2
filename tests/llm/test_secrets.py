import hashlib
import random
import re
import time

import pytest

from prosemill.llm.frames import table
from prosemill.llm.secret_scan import KINDS, secret_report, secret_spans, spans
from tests.conftest import rows
from tests.llm.common import MIDDLE, awkward, documents, empty

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


CASES = [
    "secret: token: abcdefgh", "password = x", "PASSWORD='abc12345' api-key=zz", "API_KEY:abcdefgh.apikey=12345678", "AKIAABCDEFGHIJKL AKIA12",
    "é" * 9 + " token=ABCDEFGH" + "0" * 40, "ſecret=abcdefghij", "toKen=abcdefgh", "f" * 31, "f" * 32 + "g" + "0" * 33,
]


@pytest.mark.parametrize("text", CASES)
def test_plain_patterns_stay(text):
    assert [s for s in spans(text) if s[0] != "literal"] == plain(text)


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ('x = "s3cr3tV4lue!"\nlogin.password = x', ["s3cr3tV4lue!"]),
        ('{"client_secret": "aB3$kk9!zz"}', ["aB3$kk9!zz"]),
        ('config["db_password"] = "Tr0ub4dor&3"', ["Tr0ub4dor&3"]),
        ("auth-key => 'Zk39fjWq02'", ["Zk39fjWq02"]),
        ("export DB_PASS=Xy12&&9kl2", ["Xy12&&9kl2"]),
        ('part = "AbC9xy!"\nprivate_key = part + "zzz111@Q"', ["AbC9xy!", "zzz111@Q"]),
        ('if password == "hunter22x":', []), ("pass_key: *****", []), ("password: ${DB_PASSWORD}", []),
        ('token_count = "A1b2C3d4!!"', []), ("the token of the key: nothing here", []), ('title = "A1b2C3d4!!"', []),
        ('public_key = "A1b2C3d4!!"', []),
        # references and calls are no literals, arguments are
        ("db_pwd = load_from_vault()", []), ("auth_key = compute_digest(data)", []), ("db_pwd = other_name", []),
        ('db_pwd = getenv("X", "Zx9!kq2Lm0pQr")', ["Zx9!kq2Lm0pQr"]), ('login(user="bob", db_pwd="Zx9!kq2Lm0")', ["Zx9!kq2Lm0"]),
        ('f(db_pwd=value_of_it)', []), ("DB_PWD=Abc99_xyzQ", ["Abc99_xyzQ"]), ("[db]\npwd = Abc99_xyzQ", ["Abc99_xyzQ"]),
        ('x = conf["Zx9!kq2Lm0"]\ndb_pwd = x', []), ('db_pwd: str = "Zx9!kq2Lm0"', ["Zx9!kq2Lm0"]),
        # chains, later lines, brackets, markup
        ('db_pwd = conn = "Zx9!kq2Lm0"', ["Zx9!kq2Lm0"]), ('conn = db_pwd = "Zx9!kq2Lm0"', ["Zx9!kq2Lm0"]),
        ('{"db_pwd":\n    "Zx9!kq2Lm0"}', ["Zx9!kq2Lm0"]), ('db_pwd = (\n  "Zx9!kq2Lm0"\n)', ["Zx9!kq2Lm0"]),
        ('auth_keys = ["Zx9!kq2Lm0", "Yy8?kq2Lm1"]', ["Zx9!kq2Lm0", "Yy8?kq2Lm1"]),
        ('db_pwd = """\nZx9!kq2Lm0\n"""', ["Zx9!kq2Lm0"]), ('db_pwd = "Zx9!" + \\\n  "kq2Lm0"', ["kq2Lm0"]),
        ('<db pwd="Zx9!kq2Lm0"/>', ["Zx9!kq2Lm0"]), ('<add key="DbPwd" value="Zx9!kq2Lm0"/>', ["Zx9!kq2Lm0"]),
        ("<dbPwd> Zx9!kq2Lm0 </dbPwd>", ["Zx9!kq2Lm0"]),
        # a name loses its literal with the next value
        ('x = "Zx9!kq2Lm0"\nx = load()\ndb_pwd = x', []), ('x = "Zx9!kq2Lm0"\nx += "tail!!1A"\ndb_pwd = x', ["Zx9!kq2Lm0", "tail!!1A"]),
        ('same = db_pwd == "Zx9!kq2Lm0"', []), ("it isn't the key: don't say 'Zx9!kq2Lm0'", []),
    ],
)
def test_literals_by_the_names_they_reach(text, literals):
    assert [text[a:b] for kind, a, b in spans(text) if kind == "literal"] == literals


def test_reports(spark):
    docs = documents(MIDDLE)
    got = {r[0]: r[1:] for r in rows(secret_report(table(spark, MIDDLE, "documents")), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")}
    for d in docs:
        base = plain(d["text"])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = tuple(sum(k == kind for k, _, _ in base) for kind in KINDS[:3])
        assert got[d["doc_id"]] == (*counts, hashlib.sha256(line.encode()).hexdigest())
    assert sum(r[0] + r[2] for r in got.values()) > 10


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, "y = 'k' + 'x'\n" * 50 + "token=abcdefgh"), (1, "token=abcdefgh"), (2, None)], "doc_id long, text string")
    found = sorted(rows(secret_report(df), "doc_id", "n_assign", "spans"))
    assert found == [(1, 1, "assign:0:14"), (1, 1, "assign:700:714"), (2, 0, "")]
    assert secret_spans(awkward(spark)).count() == awkward(spark).count() and secret_report(empty(spark)).count() == 0


def test_names_that_refer_to_themselves_cost_little():
    text = 'a = "Zx9!kq2Lm0"\n' + "a = a + a\n" * 20_000 + "db_pwd = a\n"
    start = time.perf_counter()
    assert spans(text) == [("literal", 5, 15)]
    many = "".join(f'a = a + "Zx9!kq2L{i:06}"\n' for i in range(20_000)) + "db_pwd = a\npassword=abcdefgh1\n" * 5_000
    assert len(spans(many)) == 25_000
    assert time.perf_counter() - start < 20


def test_very_long_texts():
    for text in ("x" * 5_000_000, "key=" + "x" * 5_000_000, "the key: of it 'all " * 250_000, "('[{" * 600_000 + "key"):
        assert [s for s in spans(text) if s[0] != "literal"] == plain(text)
    assert spans("word " * 1_000_000 + 'db_pwd = "Zx9!kq2Lm0"') == [("literal", 5_000_010, 5_000_020)]


def naive(program):
    """Literals that reach a sensitive name, by following every name at every step."""
    holds, reach = {}, {}
    for target, operands, adds in program:
        mine = set(holds.get(target, ())) if adds else set()
        for operand in operands:
            mine |= {operand} if operand.startswith("L") else holds.get(operand, set())
        holds[target] = mine
        for literal in mine:
            reach.setdefault(literal, set()).add(target)
    return {literal for literal, names in reach.items() if any("pwd" in n for n in names)}


@pytest.mark.parametrize("seed", range(20))
def test_propagation_by_following_names(seed):
    rng = random.Random(seed)
    names, program, lines = [f"n{i}" for i in range(8)] + ["my_pwd"], [], []
    for k in range(rng.randrange(5, 60)):
        target, adds = rng.choice(names), rng.random() < 0.2
        operands = [rng.choice([*names, f"L{k}x{j}?Aa1!z"]) for j in range(rng.randrange(0, 4))]
        program.append((target, operands, adds))
        right = rng.choice([" + ", " + ", " +\n  "]).join(f'"{o}"' if o.startswith("L") else o for o in operands) or "load()"
        lines.append(f"{target} {'+=' if adds else '='} {right}")
    text = "\n".join(lines)
    found = {text[a:b] for kind, a, b in spans(text) if kind == "literal"}
    assert found == naive(program)
