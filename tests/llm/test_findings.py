import hashlib
import random
import re

import corpus
import numpy as np
import pyarrow as pa
import pytest

from basketflow.llm import crf, personal_data, secret_scan, spans

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)


def secrets_by_force(text):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal_by_force(text):
    found = [
        ("email", *m.span())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


PIECES = (
    ["password: ", "PASSWD=", "secret='", 'token = "', "api_key:", "apikey=", "AKIA", "Kſ secret = "]
    + ["abcdef0123456789", "0" * 24, "deadbeef" * 4, "ABCDEFGH12345678", "x", "é", "\U0001f600", "\n"]
    + ["@", "a.b", "@x.y.z", "1.2.3.4", "300.1.1.1", ".", "+1 (226) 555-0336", "4012888888881881"]
    + ["4012-8888 8888 1881", "007.1.2.3", " ", " ", "- ", "+", "12345678901234567890", "me@host.org"]
)


def odd_texts():
    rng = random.Random(8)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 30))) for _ in range(400)] + [None, ""]


def sha(found):
    return hashlib.sha256(",".join("%s:%d:%d" % f for f in found).encode()).hexdigest()


def secret(rng, letters="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
    return "k9" + "".join(rng.choice(letters) for _ in range(30))


@pytest.fixture(scope="module")
def findings(spark):
    """Labelled texts: secrets behind their names, and mail addresses and numbers among words."""
    rng, made = random.Random(6), []
    for i in range(300):
        pieces = [corpus.text(rng, 6), f"token: {secret(rng)}", corpus.text(rng, 5)]
        pieces += [f"item-{rng.randint(10, 99)}-{corpus.word(rng)}-{corpus.word(rng)}-{corpus.word(rng)}"]
        pieces += [f"mail {corpus.word(rng)}.{i}@mail{i % 9}.org from 10.0.{i % 200}.7 call"]
        pieces += [f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now"]
        made.append((i, " ".join(pieces), "en", "s", 0))
    return spark.createDataFrame(made, corpus.SCHEMA)


def test_base_secrets_as_defined():
    texts = odd_texts()
    for text, (base, _) in zip(texts, secret_scan.find(pa.array(texts), secret_scan.SecretModel(None))):
        assert [tuple(s) for s in base] == secrets_by_force(text or "")


def test_base_personal_data_as_defined():
    texts = odd_texts()
    found = personal_data.find(pa.array(texts), personal_data.PersonalModel(None))
    for text, (base, _) in zip(texts, found):
        assert [tuple(s) for s in base] == personal_by_force(text or "")


def test_long_runs_take_linear_time():
    texts = pa.array(["1" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "1." * 100_000])
    assert len(personal_data.find(texts, personal_data.PersonalModel(None))) == 4
    assert len(secret_scan.find(texts, secret_scan.SecretModel(None))) == 4


def test_network_finds_secrets_without_a_name(spark, findings):
    model = secret_scan.fit(findings)
    rng = random.Random(31)
    hidden = [corpus.text(rng, 8) + " " + secret(rng) + " " + corpus.text(rng, 8) for _ in range(40)]
    plain = [corpus.text(rng, 8) + f" item-{i}-{corpus.word(rng)}-{corpus.word(rng)}-x" for i in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(hidden + plain)], "doc_id long, text string")
    found = secret_scan.scan_secrets(frame, model).toPandas().sort_values("doc_id")
    assert (found["n_learned"][:40] == 1).mean() >= 0.9 and (found["n_learned"][40:] == 0).mean() >= 0.9
    assert found["redacted"][:40].str.contains("[learned]", regex=False).mean() >= 0.9


def test_field_finds_numbers_that_a_run_hides(spark, findings):
    model = personal_data.fit(findings)
    text = "ask for call +1 (226) 555-0336 190.13.44.20 now"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = personal_data.scan_personal_data(frame, model).first()
    assert (row.n_phone, row.n_ip, row.n_added) == (0, 1, 1)
    start = text.index("+1")
    assert f"phone:{start}:{start + 17}" in row.spans.split(",")


@pytest.mark.parametrize("operator", ["secrets", "personal"])
def test_rows_and_columns(docs, no_docs, operator):
    if operator == "secrets":
        scan, model = secret_scan.scan_secrets, secret_scan.SecretModel(None)
    else:
        scan, model = personal_data.scan_personal_data, personal_data.PersonalModel(None)
    found = scan(corpus.clashing(docs), model).toPandas()
    assert len(found) == docs.count() and list(found.columns).count("spans") == 1
    empty = found[found["text"].isna()]
    assert (empty["base_sha256"] == sha([])).all() and empty["redacted"].isna().all()
    assert scan(no_docs, model).count() == 0


def test_nothing_to_learn_from(no_docs):
    assert secret_scan.fit(no_docs).net is None and personal_data.fit(no_docs).field is None


def test_viterbi_and_gradients_against_all_paths():
    import itertools

    rng = np.random.default_rng(2)
    field = crf.ChainField(3, 20)
    field.emit[:], field.step[:] = rng.normal(size=(20, 3)), rng.normal(size=(3, 3))
    features, sizes = rng.integers(0, 20, (6, 4, 2)), np.array([4, 1, 3, 2, 4, 1])
    scores = field.scores(features)

    def value(i, path):
        steps = sum(field.step[a, b] for a, b in zip(path, path[1:]))
        return sum(scores[i, t, y] for t, y in enumerate(path)) + steps

    best = field.decode(features, sizes)
    for i, n in enumerate(sizes):
        paths = list(itertools.product(range(3), repeat=int(n)))
        assert tuple(best[i, :n]) == max(paths, key=lambda p: value(i, p))
    truth = rng.integers(0, 3, (6, 4))

    def loss():
        total = 0
        nonlocal scores
        scores = field.scores(features)
        for i, n in enumerate(sizes):
            values = [value(i, p) for p in itertools.product(range(3), repeat=int(n))]
            total += np.log(np.exp(values).sum()) - value(i, tuple(truth[i, :n]))
        return total / len(sizes)

    emit, step = field._gradients(features, truth, sizes)
    for table, grad in ((field.emit, emit), (field.step, step)):
        for at in list(np.ndindex(table.shape))[::3]:
            old = table[at]
            table[at] = old + 1e-5
            up = loss()
            table[at] = old - 1e-5
            down = loss()
            table[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_disjoint_and_redact():
    taken = [spans.Span("a", 2, 5), spans.Span("b", 8, 9)]
    new = [spans.Span("c", x, x + 2) for x in (0, 1, 4, 5, 6, 7, 9, 10)]
    assert [s.start for s in spans.disjoint(new, taken)] == [0, 5, 9]
    assert spans.redact("0123456789", taken + [spans.Span("c", 3, 7)]) == "01[a]7[b]9"


def test_rare_findings_are_learned_from(spark):
    """Few texts have a finding, late in the text; a sample of rows would miss them."""
    rng, made = random.Random(8), []
    for i in range(600):
        text = " ".join(f"{corpus.text(rng, 3)} part{j}x{rng.randint(10, 99)}-{i}-abcdefgh" for j in range(25))
        if i % 60 == 7:
            text += f" token: {secret(rng)} call +1 (226) 555-{1000 + i} now"
        made.append((i, text, "en", "s", 0))
    frame = spark.createDataFrame(made, corpus.SCHEMA)
    assert secret_scan.fit(frame, rows=20).net is not None
    assert personal_data.fit(frame, rows=20).field is not None


def test_threshold_keeps_the_recall_without_names():
    """Values like the others' can be told by their names only; without these the recall still holds."""
    rng = np.random.default_rng(5)
    truth = np.repeat([0, 1], [900, 100])
    windows = rng.integers(97, 123, (1000, secret_scan.LENGTH)).astype(np.uint8)
    windows[:, : secret_scan.BEFORE] = 32
    windows[truth == 1, 10 : secret_scan.BEFORE] = np.frombuffer(b"the  token  : ", np.uint8)
    model = secret_scan._calibrated(windows, truth, 0.99, 5)
    held = np.random.default_rng(5).random(1000) < 0.3
    secrets = windows[held & (truth == 1)]
    bare = secrets.copy()
    bare[:, : secret_scan.BEFORE] = 0
    for some in (secrets, bare):
        assert (model.probabilities(some) >= model.threshold).mean() >= 0.99
    assert model.threshold < 0.5


def test_near_spans_by_force():
    rng = random.Random(2)
    for _ in range(200):
        some = [spans.Span("x", a, a + rng.randint(1, 9)) for a in (rng.randint(0, 40) for _ in range(8))]
        start = rng.randint(0, 40)
        end = start + rng.randint(1, 9)
        want = [s for s in some if s.start < end and start < s.end]
        assert [s for s in spans.near(some)(start, end) if start < s.end] == want


def test_secret_model_learns_from_every_candidate(spark):
    """more distinct candidates than ROWS of one label all reach the model, none sampled away."""
    others = [(i, f"note Ab12cd34Ef56gh78XY{i:05d} here") for i in range(secret_scan.ROWS + 100)]
    secrets = [(10**6 + i, f"password=Qz{i:04d}abc123def456ghi789") for i in range(40)]
    frame = spark.createDataFrame(others + secrets, "doc_id long, text string").repartition(4)
    model = secret_scan.fit(frame, steps=2)
    assert model.net is not None
    assert model.examples == (secret_scan.ROWS + 100, 40)
