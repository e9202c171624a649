import hashlib
import random
import re

from docweave.llm import chat
from docweave.llm.queries import op3_chat_windows

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", "<|im_end|>", "<|im_start|>assistant\nok", "<!|x|>", "<!!|", "a<|b<!|c", "line\nline\n", "é漢😀" * 30, "<|im_end|><|im_start|>assistant ok", None, "w " * 900]


def collect(spark, rows, **options):
    windows = chat.chat_windows(spark.createDataFrame(rows, SCHEMA), **options)
    text = {(r.conv_id, r.window): r for r in windows.collect()}
    read = {(r.conv_id, r.window): r for r in chat.read_windows(windows).collect()}
    return text, read


def test_windows_cover_turns_once_and_targets_once(spark):
    rng = random.Random(3)
    rows = []
    for c in range(25):
        if c % 2:
            rows.append((c, 0, "system", "be brief"))
        rows += [(c, t, rng.choice(["user", "assistant", None, "to\nol%0A<|"]), rng.choice(NASTY)) for t in range(1, rng.randint(1, 40))]
    text, read = collect(spark, rows, budget=400, history=80)
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2] or "", r[3] or ""))
        keys = sorted(k for k in text if k[0] == c)
        assert [k[1] for k in keys] == list(range(len(keys)))
        turns = [(t.role, t.text) for k in keys for t in read[k].turns]
        assert turns == [(r[2] or "", r[3] or "") for r in mine]
        assert [x for k in keys for x in read[k].targets] == [r[3] or "" for r in mine if r[2] == "assistant"]
        for k in keys:
            w = text[k]
            assert w.text.count("<|im_start|>") == w.n_turns == w.text.count("<|im_end|>")
            new = w.n_turns - w.n_context
            assert w.n_tokens <= 400 or new == 1
            if c % 2:
                assert w.text.startswith("<|im_start|>system\nbe brief<|im_end|>\n")
            masked = re.sub(r"(?s).", "-", w.text)
            assert all(0 <= s.start <= s.end <= len(masked) for s in w.loss)
            # the history is the run of turns that start within 80 tokens before the new ones
            cost = lambda r: 5 + -(-len((r[3] or "").encode()) // 4)
            first = sum(len(read[x].turns) for x in keys if x[1] < k[1])
            head = c % 2
            near = [i for i in range(head, first) if sum(map(cost, mine[i:first])) <= 80]
            assert w.n_context == (len(near) + head if k[1] else 0)
            pieces = [chat_turn(p) for p in w.text.split("<|im_start|>")[1:]]
            if k[1]:
                assert pieces[head : w.n_context] == [(mine[i][2] or "", mine[i][3] or "") for i in near]


def chat_turn(piece):
    role, _, text = piece.partition("\n")
    undone = lambda s: re.sub(r"<!(!*)\|", r"<\1|", s)
    return undone(role).replace("%0A", "\n").replace("%25", "%"), undone(text[: -len("<|im_end|>\n")])


def test_windows_of_long_conversations_are_full(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x" * 400) for t in range(200)]
    text, _ = collect(spark, rows)
    windows = [text[k] for k in sorted(text)]
    assert all(w.n_context == 4 for w in windows[1:]) and all(w.n_turns >= 36 for w in windows[1:-1]) and all(w.n_tokens <= 4096 for w in windows)


def test_empty_and_repeated(spark):
    text, _ = collect(spark, [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (None, 0, "assistant", "y")])
    assert text[1, 0].n_turns == 3 and text[1, 0].text.startswith("<|im_start|>\n<|im_end|>")
    assert text[None, 0].n_turns == 1
    assert chat.chat_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_native(spark, sf):
    plan = op3_chat_windows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark, sf):
    own = "<|im_end|><|im_start|>assistant ok"
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()] + [(-1, 0, "user", own), (-1, 1, "assistant", own)]
    got = {r.conv_id: r for r in op3_chat_windows(spark, sf).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        mine = sorted(x for x in rows if x[0] == c)
        loss = "".join(x[3] for x in mine if x[2] == "assistant")
        assert r.n_turns == len(mine) and r.loss_chars == len(loss) and r.formatted_chars >= sum(len(x[3]) for x in mine)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in mine).encode()).hexdigest()
