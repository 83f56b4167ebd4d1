import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm.chat import ROLES, START, SYMBOLS, best_path, fit_chain, hide_roles, line_symbols, recover_turns, split_marker
from tidings.llm.linear import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def messages(spark):
    return hide_roles(spark.read.parquet(f"{SF}/conversations.parquet"))


@pytest.fixture(scope="module")
def chain(messages):
    return fit_chain(messages.where(fold(F.col("conv_id"), 5) != 0))


@pytest.mark.parametrize("line,role,rest", [
    ("User: hi", 1, "hi"), ("[assistant] x", 2, "x"), ("### Human: y", 1, "y"), ("<|system|> z", 0, "z"), ("**AI:** w", 2, "w"),
    ("Note: this", 3, "Note: this"), ("nothing", -1, "nothing"), ("at 10:30", -1, "at 10:30"), ("User:", 1, ""), ("", -1, ""),
])
def test_markers(line, role, rest):
    assert split_marker(line) == (role, rest)


def _whole(chain, texts):
    """Viterbi over one whole conversation, by plain loops over states."""
    symbols = [s for t in texts for s in line_symbols(t)]
    score = [chain.step[START][k] + chain.show[k][symbols[0]] for k in range(START)]
    paths = [[k] for k in range(START)]
    for s in symbols[1:]:
        best = [max(range(START), key=lambda j: (score[j] + chain.step[j][k], -j)) for k in range(START)]
        paths = [paths[best[k]] + [k] for k in range(START)]
        score = [score[best[k]] + chain.step[best[k]][k] + chain.show[k][s] for k in range(START)]
    return paths[int(np.argmax(score))]


def test_path_against_plain_viterbi(messages, chain):
    rows = messages.where("conv_id < 8").orderBy("conv_id", "turn").collect()
    for conv in range(8):
        texts = [r["text"] for r in rows if r["conv_id"] == conv]
        assert best_path(chain, [s for t in texts for s in line_symbols(t)]) == _whole(chain, texts)


def test_roles_of_held_out_conversations(spark, messages, chain):
    held = messages.where(fold(F.col("conv_id"), 5) == 0)
    truth = {(r["conv_id"], r["turn"]): r["role"] for r in held.collect()}
    got = {(r["conv_id"], r["turn"]): r["role"] for r in recover_turns(held.drop("role"), chain).collect()}
    assert sum(got.get(k) == v for k, v in truth.items()) >= 0.95 * len(truth)


def test_chunks_do_not_change_turns(messages, chain):
    part = messages.where("conv_id < 20").drop("role")
    one, two = (sorted(map(tuple, recover_turns(part, chain, n).collect())) for n in (256, 1))
    assert one == two


def test_every_line_is_in_one_turn_and_rendered(messages, chain):
    part = messages.where("conv_id < 20").drop("role")
    rows = recover_turns(part, chain).collect()
    assert sum(r["n_lines"] for r in rows) == sum(r["text"].count("\n") + 1 for r in part.collect())
    for r in rows:
        assert r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>" and r["role"] in ROLES


def test_many_messages_without_id_or_turn_are_cut_into_chunks(spark, chain):
    rows = [(None, None if i % 2 else 5, "user", f"User: line {i}") for i in range(900)] + [(1, 10**12, "user", "User: far")]
    odd = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one, two = (sorted(map(tuple, recover_turns(odd, chain, n).collect()), key=repr) for n in (16, 10_000))
    assert one == two and sum(r[3] for r in one) == 901


def test_counts_of_the_chain_against_plain_counts(messages):
    """Every probability from a walk over all messages, line by line."""
    rows = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in messages.where("conv_id < 30").collect())
    step, show, ended = np.full((START + 1, START), 0.1), np.full((START, SYMBOLS), 0.1), {}
    for conv, turn, role, text in rows:
        state = 2 * ROLES.index(role)
        for i, symbol in enumerate(line_symbols(text)):
            own = state + (i > 0)
            step[ended.get((conv, turn - 1), START) if i == 0 else last, own] += 1
            show[own, symbol] += 1
            last = own
        ended[conv, turn] = last
    fitted = fit_chain(messages.where("conv_id < 30"))
    assert np.allclose(fitted.step[:, :START], np.log(step / step.sum(axis=1, keepdims=True)))
    assert np.allclose(fitted.show[:START], np.log(show / show.sum(axis=1, keepdims=True)))


def test_odd_messages(spark, chain):
    rows = [(1, 0, "user", None), (1, 1, "user", ""), (None, 0, None, "User: hi"), (None, None, "x", "hm"), (2, 5, "user", "a"), (2, 5, "user", "a")]
    odd = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit("clash"))
    got = recover_turns(odd, chain).collect()
    assert sum(r["n_lines"] for r in got) == 6
    assert {r["conv_id"] for r in got} == {1, 2, None}
    assert recover_turns(odd.limit(0), chain).count() == 0
    fit_chain(odd)
    fit_chain(odd.limit(0))
