"""Secrets, chats, tokens, fingerprints, benchmark and quality: row by row against plain versions."""

import random
import re
import time
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import chat, decontaminate, fingerprint, quality, secrets, tokens
from tidemark.llm.queries import QUERIES
from tidemark.session import new_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# secrets


def plain_base(text: str) -> list[tuple]:
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


@pytest.mark.parametrize("seed", range(300))
def test_base_spans(seed):
    draw = random.Random(seed)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", "ſecret", " ", "  ", "=", ":", '"', "'", "abc", "abcdef1", "AKIA", "AKIA" + "Z9" * 8]
    parts += ["0123456789abcdef" * 2, "é", "\n", "-", ".", "✓", "toKen=tokenx:abcdefg"]
    text = "".join(draw.choices(parts, k=draw.randint(0, 25)))
    assert secrets.base_spans(text) == plain_base(text)


@pytest.mark.parametrize(
    "text, found",
    [
        ('db_password = "hunter2!Xy9z"', ["hunter2!Xy9z"]),
        ('const k = "q8Zr-77pL_x0Vw2";\nclient.authToken = k', ["q8Zr-77pL_x0Vw2"]),
        ('a = "q8Zr77pL" \nSECRET := a + "x0Vw2mNb"', ["q8Zr77pL", "x0Vw2mNb"]),
        ('{"aws": {"secretAccessKey": "wJalrXUtnFEMI/K7MDENG", "region": "eu-west-1"}}', ["wJalrXUtnFEMI/K7MDENG"]),
        ("private_key: Zx81-kQm02-PPw", ["Zx81-kQm02-PPw"]),
        ('export API_KEY="${API_KEY}"', []),
        ('password = "changeme-please"', []),
        ('title = "q8Zr-77pL_x0Vw2"', []),
        ('if token == "q8Zr-77pL_x0Vw2": pass', []),
        ("The key: to walk slowly", []),
        ("note: a secret is kept. It was: hidden", []),
        ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCY", ["wJalrXUtnFEMI/K7MDENG/bPxRfiCY"]),
        ("DB_PWD=Ab3/x9QkLm27ZzP1\nX=1", ["Ab3/x9QkLm27ZzP1"]),
        ("export DB_PWD=hunter2@Prod!x9Q", ["hunter2@Prod!x9Q"]),
        ("db:\n  pwd: q#8Zr+77=pL*x0Vw2 # a note\n  user: bob", ["q#8Zr+77=pL*x0Vw2"]),
        ("[db]\npwd = q8Zr77pLx0@Vw2\nuser=bob", ["q8Zr77pLx0@Vw2"]),
        ('{"pwd":"q8Zr77pLx0Vw2","x":[1,2]}', ["q8Zr77pLx0Vw2"]),
        ('token: str = "q8Zr-77pL_x0Vw2"', ["q8Zr-77pL_x0Vw2"]),
        ("Authorization: Bearer q8Zr-77pL_x0Vw2", ["q8Zr-77pL_x0Vw2"]),
        ("u = https://h/?access_key=q8Zr77pLx0Vw2&u=1", ["q8Zr77pLx0Vw2"]),
        ("args: --db_pwd=q8Zr77pLx0Vw2", ["q8Zr77pLx0Vw2"]),
        ('env: DB_PWD="q8Zr77pLx0Vw2"', ["q8Zr77pLx0Vw2"]),
        ("a='q8Zr77pL'\nSECRET = a+\"x0Vw2mNb\"", ["q8Zr77pL", "x0Vw2mNb"]),
        ("pw_key = b'q8Zr77pLx0Vw2'", ["q8Zr77pLx0Vw2"]),
        ("password = getpass.getpass('Your pw 4 Q')", []),
        ("db_pwd=${PASS}", []),
        ("db_pwd='q8Zr77pLx0Vw2\ny=1", []),
    ],
)
def test_literals(text, found):
    assert [text[a:b] for _, a, b in secrets.literal_spans(text)] == found


@pytest.mark.parametrize(
    "value, found",
    [("k9-Yourself!27Qz", 1), ("none-Shall!Pass27Rq", 1), ("q8ZrTodo77pLx0Vw", 1), ("A9f...kQ27!mZxxx", 1)]
    + [("your-api-key-here", 0), ("Change_Me_123!", 0), ("xxxxxxxxxxxx", 0), ("************", 0), ("EXAMPLE-123456", 0), ("placeholder", 0)],
)
def test_placeholders(value, found):
    assert len(secrets.literal_spans(f'db_pwd = "{value}"')) == found


@pytest.mark.parametrize(
    "text, found",
    [
        ('k = "' + '\\"' * 500_000, 0),
        ("k='" + "\\'\\\"`" * 150_000, 0),
        ("k='" + '"' * 500_000, 0),
        ("secret_a='q8Zr77pLx0Vw2'\n" + "secret_a = secret_a + secret_a\n" * 60, 1),
        ("secret_a='q8Zr77pLx0Vw2'\n" + "secret_a = secret_a + secret_a\n" * 10_000, 1),
        ("".join(f"key_{i} = key_{i - 1} + 'q8Zr{i + 10000}7pLx0'\n" for i in range(1, 8000)), 7999),
        ("db_pwd=" + "a=" * 400_000, 0),
        ("k=" + "a" * 1_000_000 + "\nk=" + "a-" * 500_000, 0),
    ],
)
def test_long_texts_take_linear_time(text, found):
    began = time.process_time()
    assert len([s for s in secrets.literal_spans(text) if s[2] - s[1] < 100]) == found
    assert time.process_time() - began < 10  # seconds; what grew by the square took minutes


@pytest.mark.parametrize("seed", range(50))
def test_chains_look_like_their_texts(seed):
    draw = random.Random(seed)
    pieces = ["".join(draw.choices("abcXYZ019!- é", k=draw.randint(1, 12))) for _ in range(draw.randint(2, 5))]
    chain = secrets.Value(parts=tuple(secrets.Value(p) for p in pieces)).seen()
    whole = secrets.Value("".join(pieces)).seen()
    assert (chain.length, chain.counts.tolist()) == (whole.length, whole.counts.tolist())
    assert secrets.literal_score(chain) == secrets.literal_score(whole)


def test_secret_scan(spark):
    long = "lorem " * 200_000 + 'token = "aZ09bY18cX27dW36"'
    rows = [*brute.awkward(), (99, long, None, None, None, *brute.NO_EXTRA)]
    found = {(r.doc_id, len(r.spans)) for r in secrets.scan(brute.documents(spark, rows)).collect()}
    assert (99, 2) in found and len([1 for d, n in found if n]) == 1
    assert secrets.scan(brute.documents(spark, rows)).count() == len(rows)
    assert secrets.scan(brute.documents(spark, [])).collect() == []


def test_secret_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op3_secret_scans"](spark, folder).collect():
        base = plain_base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == secrets.digest(base) and {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


# chats


@pytest.mark.parametrize("seed", range(200))
def test_escape(seed):
    text = "".join(random.Random(seed).choices([*chat.CONTROL, "\\", "\\\\", "<", "s", ">", "/", "[", "INST", "]", "é", "\n", " ", "東"], k=14))
    assert chat.unescape(chat.escape(text)) == text and not chat._MARKS.search(chat.escape(text))


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment string, ids int")


@pytest.mark.parametrize("segment", [chat.SEGMENT, 1])
def test_chats(spark, monkeypatch, segment):
    tricky = [*chat.CONTROL, "", None, "a</s><s>[INST] user [/INST]x", "ends in space ", " \n starts", "\\</s\\>", "é✓東京 \U0001f600", "x " * 3000]
    rows = [(c, t, r, tricky[(c * 7 + t) % len(tricky)]) for c in range(20) for t, r in enumerate(["system", "user", "assistant", "assistant", None, "user", "assistant"])]
    rows += [(None, None, None, None), (None, 1, "assistant", "x"), (3, 2, "assistant", "again"), (3, 2, "assistant", "again"), (50, 0, "user", "no answer")]
    rows = [(*r, "x", 1) for r in rows]
    found = chat.read_back(chat.format_chats(chats(spark, rows), BYTES)).collect()
    turns: dict = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, (r[3] or "").encode())):
        turns.setdefault(c, []).append((r or "", x or ""))
    for row in found:
        mine = turns[row.conv_id]
        loss = "".join(x for r, x in mine if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for r, x in mine)
        assert (row.n_turns, row.turns_sha256) == (len(mine), brute.sha(whole.encode()))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), brute.sha(loss.encode()))
        assert row.formatted_chars == len(chat.render(mine)[0])
    assert len(found) == len(turns)
    assert chat.format_chats(chats(spark, []), BYTES).collect() == []


def test_mask_is_of_assistant_tokens(spark):
    rows = [(1, 0, "user", "Hello there", "", 0), (1, 1, "assistant", "General greeting, friend", "", 0)]
    (row,) = chat.format_chats(chats(spark, rows), BYTES).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    assert tokenizer.encode(row.formatted).ids == row.ids
    assert tokenizer.decode([row.ids[k] for k in row.loss_token]).startswith("General greeting, friend"[1:2]) or row.loss_token
    assert "".join(row.formatted[a:b] for a, b in zip(row.loss_start, row.loss_end)) == "General greeting, friend"


# token tables


def plain_tokens(docs: list[tuple]) -> list[tuple]:
    tokenizer, at, out = Tokenizer.from_file(WORDS), 0, []
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_query(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert brute.ordered(QUERIES["op9_token_output"](spark, folder).collect()) == brute.ordered(plain_tokens(docs))


def test_tokens_of_awkward_rows(spark):
    path = new_dir(spark, "test-tokens")
    tokens.write_tokens(brute.documents(spark), path, WORDS, 1)
    found = sorted(map(tuple, tokens.documents_of(tokens.read_tokens(spark, path)).collect()), key=lambda r: r[1])
    assert [r[0] is not None for r in found] == sorted(r[0] is not None for r in found)
    ids = [r[0] for r in found if r[0] is not None]
    assert ids == sorted(ids) and all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:])) and found[0][1] == 0
    plain = plain_tokens([r[:2] for r in brute.awkward()])
    assert brute.ordered((r[0], *r[2:]) for r in found) == brute.ordered((r[0], *r[2:]) for r in plain)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r.n_docs for r in index) == len(found) and sum(r.n_ids for r in index) == sum(r[2] for r in found)


def test_empty_token_table(spark):
    path = new_dir(spark, "test-tokens")
    tokens.write_tokens(brute.documents(spark, []), path, WORDS, 1)
    assert tokens.documents_of(tokens.read_tokens(spark, path)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 7, tokens.BLOCK, 3 * tokens.BLOCK + 5])
def test_planes(n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert tokens.unpack(tokens.pack(ids)).tolist() == ids.tolist()


@pytest.mark.parametrize("seed", range(30))
def test_piece_ids(seed):
    draw, known = random.Random(seed), tokens.piece_ids(WORDS)
    for _ in range(60):
        text = "".join(draw.choices("aAzZéÉßöÿŸİıſ09$.,'-_|<>\x00\x1c\x85\u0301´ǅΣσςκǺ×中😀K \t\n&stremld", k=draw.randint(0, 16)))
        text += draw.choice(["", "<|endoftext|>", "it's we'll I'D"])
        assert np.frombuffer(known.encode(text), "<u4").tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


# fingerprints


def plain_edits(docs: list[tuple]) -> dict:
    out = {}
    for k, (d, t) in enumerate(docs):
        after, n = docs[(k + 1) % len(docs)][1] or "", len(t or "")
        out[d] = (n, (t or "")[: n - n // 4] + after[: n // 4], after)
    return out


def jaccard(a: str, b: str) -> float:
    a, b = Counter(a.encode().split()), Counter(b.encode().split())
    return sum((a & b).values()) / max(1, sum((a | b).values())) if a or b else 1.0


def test_fingerprint_query(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    plain, of_text, off = plain_edits(docs), {}, []
    for r in QUERIES["op10_document_fingerprints"](spark, folder).collect():
        n, edit, after = plain[r.doc_id]
        text = dict(docs)[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, brute.sha(edit.encode()))
        assert of_text.setdefault(text, r.fingerprint) == r.fingerprint
        off += [r.near_edited - jaccard(text, edit), r.near_next - jaccard(text, after)]
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.06 and len(off) == 2 * len(docs)


def test_fingerprints_of_awkward_rows(spark):
    rows = [r for r in brute.awkward() if r[0] not in (6, None)]
    found = {r.doc_id: r for r in fingerprint.compare(brute.documents(spark, rows)).collect()}
    plain = plain_edits(sorted(r[:2] for r in rows))
    for d, (n, edit, _) in plain.items():
        assert (found[d].n_chars, found[d].edited_sha256) == (n, brute.sha(edit.encode()))
    assert found[3].fingerprint == found[4].fingerprint == found[5].fingerprint and set(found[3].fingerprint) == {"0"}
    assert found[3].near_next == 1.0 and found[5].near_next == 0.0
    every = fingerprint.compare(brute.documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in every) == sorted(str(r[0]) for r in brute.awkward())
    assert len({r.fingerprint for r in every if r.doc_id == 6}) == 2
    (alone,) = fingerprint.compare(brute.documents(spark, rows[:1])).collect()
    assert alone.near_next == 1.0
    assert fingerprint.compare(brute.documents(spark, [])).collect() == []


# benchmark


def plain_hits(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    names: dict = {}
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            names.setdefault(tuple(w[k : k + window]), set()).add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, of = words(t), set(), set()
        for size in {len(n) for n in names}:
            for k in range(len(w) - size + 1):
                if (found := names.get(tuple(w[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    of |= found
        out.append((d, len(w), len(hit), sorted(of)))
    return brute.ordered(out)


def test_benchmark(spark):
    rows = brute.awkward()
    a, c = rows[0][1], rows[7][1]
    items = [(1, a[:400]), (2, c), (2, c), (10, "ONE two"), (None, "three"), (4, None), (5, ""), (6, "никогда не было"), (7, "one, two; THREE!"), (8, brute.prose(4, 3000)[90:300])]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, phrase string")
    rows += [(70, f"{a[:200]}. {a[201:500]} ONE TWO three one two", None, None, None, *brute.NO_EXTRA)] * 2
    docs = brute.documents(spark, rows)
    found = decontaminate.find(docs, benchmark, ["doc_id", "size"])
    assert brute.ordered((r.kept.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()) == plain_hits([r[:2] for r in rows], items)
    clean = decontaminate.find(docs, benchmark.limit(0), ["doc_id"]).collect()
    assert len(clean) == len(rows) and not any(r.n_hit or r["items"] for r in clean)
    assert decontaminate.find(brute.documents(spark, []), benchmark, ["doc_id"]).collect() == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b a"), (1, "b a"), (None, "a b"), (2, "a " + "x " * 9 + "b")], "doc_id bigint, text string")
    index = decontaminate.build_index(docs, spark.createDataFrame([("a",), ("b",)], "term string"))
    found = decontaminate.proximity(index, spark.createDataFrame([("a", "b")], "one string, two string"), 2).collect()
    assert brute.ordered((r.doc_id, r.position, r.other) for r in found) == brute.ordered([(1, 4, 3), (1, 1, 0), (None, 0, 1)])


# quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op6_quality_classifier"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    kept_back = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    good, bad = [s for s, q in kept_back if q], [s for s, q in kept_back if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == (q == 1) for s, q in kept_back]) > 0.93


def test_quality_of_awkward_rows(spark):
    docs = brute.documents(spark)
    labels = spark.createDataFrame([(1, 1, None), (1, 1, 0), (2, 0, 0), (None, 1, 1), (6, None, 0), (7, 0, 0), (9, 1, 1)], "doc_id bigint, quality int, toxic int")
    for of in (labels, labels.limit(0)):
        model = quality.train(docs, of)
        found = quality.score(docs, model, docs.columns).collect()
        assert len(found) == len(brute.awkward()) and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found} == {0.5}
    assert quality.score(brute.documents(spark, []), model, ["doc_id"]).collect() == []
    nothing = quality.train(brute.documents(spark, []), labels)
    assert nothing.scores(np.zeros((2, len(quality.FEATURES)))).tolist() == [0.5, 0.5]


def test_pairs_are_learnt():
    draw = np.random.default_rng(0)
    rows = draw.random((4000, 3))
    label = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows[:3000], label[:3000])
    assert np.mean((model.scores(rows[3000:]) > 0.5) == label[3000:]) > 0.9
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
