import hashlib
import random
import re

from pyspark.sql import functions as F

from flightlake.llm.chat import event_log, final_messages, format_conversations, read_back, under_loss

EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<s>", "a\\b", "\\</s>", "<\\s>", "[INST", "]\\", "<", "/s>", "é🙂\n[/INST]\n", "", None, "<</s>>"]


def folded(events):
    """Final (conv, role, text) in order, one event after another."""
    state = {}
    key = lambda v: (v is not None, v if v is not None else 0)
    for conv, message, seq, kind, role, text in sorted(set(events), key=lambda e: (key(e[2]), *[(x is not None, x or "") for x in e[3:]])):
        m = state.setdefault((conv, message), {"at": seq, "role": "", "text": ""})
        m["role"] = role if role is not None else m["role"]
        if kind in ("edit", "regenerate"):
            m["text"] = ""
        if kind in ("open", "delta", "edit"):
            m["text"] += text or ""
    by = {}
    for (conv, message), m in sorted(state.items(), key=lambda x: (key(x[1]["at"]), key(x[0][1]))):
        by.setdefault(conv, []).append((m["role"], m["text"]))
    return by


def random_events(seed):
    rng = random.Random(seed)
    out = []
    for conv in [None, *range(8)]:
        for message in [None, *range(rng.randint(1, 6))]:
            role = rng.choice(["user", "assistant", "assistant", "sys\\tem</s>", None])
            seqs = sorted(rng.sample(range(1000), rng.randint(1, 9)))
            for i, seq in enumerate(seqs):
                kind = "open" if not i else rng.choice(["delta"] * 5 + ["edit", "regenerate", None, "seen"])
                event = (conv, message, seq if rng.random() > 0.05 or i else None, kind, role if kind in ("open", "seen") else None, rng.choice(NASTY))
                out += [event] * rng.choice([1, 1, 1, 2, 3])
    rng.shuffle(out)
    return out


def check(out, want):
    got = {}
    back = read_back(F.col("formatted"))
    for r in out.select("conv_id", "formatted", "loss_runs", back["n_turns"].alias("n"), back["turns"].alias("turns"),
                        under_loss(F.col("formatted"), F.col("loss_runs")).alias("loss")).collect():
        turns = want[r.conv_id]
        assert r.n == len(turns) == r.formatted.count("</s>") == r.formatted.count("<s>[INST]") == r.formatted.count("[/INST]")
        assert r.turns == "".join(f"{role}\n{text}\n" for role, text in turns)
        learnt = [text for role, text in turns if role == "assistant"]
        assert r.loss == "".join(learnt)
        # The runs hold for the formatted text as it stands, in code points.
        at, spans = 0, []
        for run in r.loss_runs:
            at += run.skip
            spans.append(r.formatted[at : at + run.learn])
            at += run.learn
        assert at == len(r.formatted)
        assert "".join(re.sub(r"(?s)\\(.)", r"\1", s) for s in spans) == "".join(learnt)
        got[r.conv_id] = True
    assert set(got) == set(want)


def test_random_logs_match_a_plain_fold(spark):
    for seed in (1, 2):
        events = random_events(seed)
        df = spark.createDataFrame(events, EVENTS).repartition(5).selectExpr("*", "1 AS log", "'x' AS at", "2 AS `a.b`")
        check(format_conversations(df), folded(events))


def test_log_of_rows_gives_the_rows_back(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([*NASTY, "long " * 2000])) for c in [None, 1, 2, 3] for t in range(8)]
    rows += [(4, None, "user", "no turn"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3).selectExpr("*", "'z' AS hash", "1 AS `x.y`", "0 AS message")
    log = event_log(df)
    assert log.filter("kind IN ('edit', 'regenerate')").count() > 3
    assert log.groupBy("conv_id", "message", "seq").count().filter("count > 1").count() > 3
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)):
        want.setdefault(conv, []).append((role or "", text or ""))
    check(format_conversations(log), want)


def test_one_conversation_of_many_turns(spark):
    n = 20_000
    df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    out = format_conversations(event_log(df))
    row = out.select("*", read_back(F.col("formatted"))["turns"].alias("turns"), under_loss(F.col("formatted"), F.col("loss_runs")).alias("loss")).first()
    assert hashlib.sha256(row.turns.encode()).digest() == hashlib.sha256("".join(f"{'user' if i % 2 == 0 else 'assistant'}\nt{i}\n" for i in range(n)).encode()).digest()
    assert row.loss == "".join(f"t{i}" for i in range(1, n, 2))


def test_empty_log_and_no_python(spark):
    none = spark.createDataFrame([], EVENTS)
    assert format_conversations(none).count() == 0 and final_messages(none).count() == 0
    read = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = format_conversations(event_log(read))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
