"""The derived event log has every kind of event, and folding it gives the rows back."""

import hashlib
import random
from collections import Counter, defaultdict

from extracteval.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_every_event_kind_is_undone(spark):
    rnd = random.Random(8)
    rows = []
    for conv in range(40):
        for turn in range(rnd.randint(1, 9)):
            text = rnd.choice(["", "short", "long " * 300, "</s>[INST] \\ <|end|>"]) + f" {conv} {turn}" if rnd.random() < 0.9 else None
            rows.append((conv, turn - 3, "assistant" if turn % 2 else "user", text))
    rows += rows[5:25] + rows[5:15]  # repeated rows
    rows += [(3, 2, "assistant", "another of this turn"), (3, None, "user", "no turn"), (3, 1 << 50, "user", "far"), (None, 0, None, "x"), (4, -(1 << 60), "user", "first")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    events = chat.conversation_events(df, 64).persist()
    kinds = Counter(r.kind for r in events.select("kind").collect())
    assert all(kinds[k] > 5 for k in ("open", "delta", "edit", "regenerate", "delete"))
    got = defaultdict(list)
    for r in chat.format_events(events).collect():
        got[r.conv_id].append((r.ord, chat.parse(r.formatted)))
    events.unpersist()
    want = defaultdict(list)
    for c, t, r, x in rows:
        want[c].append((t, r or "", x or ""))
    assert {c: len(v) for c, v in got.items()} == {c: len(v) for c, v in want.items()}
    for c, turns in want.items():
        said = [m for _, m in sorted(got[c])]
        order = sorted({t for t, _, _ in turns}, key=lambda t: (t is not None, t or 0))
        at = 0
        for t in order:
            part = [(r, x) for u, r, x in turns if u == t]
            assert sorted(said[at : at + len(part)]) == sorted(part)
            at += len(part)


def test_digests_read_back_from_the_log(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k} é") for k in range(12)]
    found = chat.digest_conversations(chat.format_events(chat.conversation_events(spark.createDataFrame(rows, SCHEMA)))).collect()
    (r,) = found
    assert r.n_turns == 12
    assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, _, role, x in rows).encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256("".join(x for _, _, role, x in rows if role == "assistant").encode()).hexdigest()
