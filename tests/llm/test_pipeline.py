import corpus_pipeline as P
import __spark_entry__ as entry

from .conftest import SF


def test_stages_take_effect(spark, make):
    long = "this line is long enough to be counted as a line of its own"
    rows = [(k, f"the cat number{k} sat on mat{k} and looked at dog{k} with a smile{k}\n{long}", "en", "a") for k in range(30)]
    rows += [(100 + k, f"der hund nummer{k} lag auf dem teppich{k} und sah die katze{k} an", "de", "b") for k in range(30)]
    rows += [(200, None, None, None), (201, "12345 !!!", "en", "a"), (202, rows[59][1], "de", "b")]
    docs = make(rows)
    out = docs
    seen = []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns, name
        out = P.stored(out)
        seen.append(out.count())
    assert seen[0] == 61 and seen[1] == 61 and seen[2] == 60
    kept = {r.doc_id: r for r in out.collect()}
    assert all(long not in r.text and r.n_chars == len(r.text) for i, r in kept.items() if i < 29)
    last = P.STAGES[-1][1](spark, out, SF)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == seen[3]


def test_empty_table_and_unlabelled(spark, make):
    out = make([])
    for _, stage in P.STAGES:
        out = stage(spark, out, SF)
    assert out.count() == 0
    docs = make([(1, "some text"), (2, None)])
    assert P.STAGES[0][1](spark, docs, SF).count() == 2


def test_repeated_and_null_ids(spark, make):
    """Rows are taken and dropped as rows, documents counted as ids."""
    from collections import Counter

    from spanlab.llm.line_dedup import LineIndex

    def through(stage, rows):
        return Counter((r.doc_id, r.text, r.source) for r in stage(spark, make(rows), SF).collect())

    def counter(rows):
        return Counter((i, t, s) for i, t, _, s in rows)

    long = "this line is long enough to be counted as a line of its own"
    rows = [(1, long, "en", "a")] * 4 + [(2, long, "en", "a")]
    assert through(P.line_stage, rows) == counter(rows)
    state = lambda x: sorted(map(tuple, x.refs.select("key", "n_docs", "max_doc").collect()))
    more = make([(3, long), (3, long), (4, long + "!")])
    both = LineIndex.build(make(rows)).insert(more)
    assert sorted(r[1:] for r in state(both)) == [(1, 4), (3, 3)]
    assert state(both.delete(more.select("doc_id"))) == state(LineIndex.build(make(rows)))
    rows += [(k, long, "en", "a") for k in (3, 4, 5)]
    assert through(P.line_stage, rows) == counter([(i, long if i == 5 else "", "en", "a") for i, *_ in rows])

    one, two, three = (" ".join(f"{w}{k}" for k in range(30)) for w in ("cat", "dog", "owl"))
    rows = [(9, one, "en", "a"), (4, one, "en", "a"), (4, one, "en", "a"), (4, two, "en", "a"), (3, one, "en", "b"),
            *[(7, three, "en", "a")] * 3, (None, one, "en", "a"), (None, one, "en", "a"), (8, None, "en", "a"), (8, None, "en", "a")]
    assert through(P.near_stage, rows) == counter([rows[3], rows[4], rows[5], *rows[8:]])

    rows = [(i, "one two three", "en", s) for s in "ab" for i in (4, 4, 4, None, None, None)]
    got = Counter(s for (_, _, s), n in through(P.mixing_stage, rows).items() for _ in range(n))
    assert got == {"a": 9, "b": 3}  # budgets of 26 and 10 words
    rows = [(i, "one two three", "en", "a") for i in (4, 4, 4, None, None, 5)]
    assert through(P.mixing_stage, rows) == counter(rows)


def test_odd_rows_go_through_the_later_stages(spark, odd):
    docs = odd
    for _, stage in P.STAGES[1:-1]:
        docs = P.stored(stage(spark, docs, SF))
    # copies of (4, one two three), (5, long) = (6, long) leave one row; texts without words are not taken by the mix
    assert docs.filter("doc_id = 4 and text = 'one two three'").count() <= 3 and docs.filter("doc_id = 6").count() == 0
    assert docs.filter("doc_id is null").count() > 0
    assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_registered(spark):
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op") and n[2].isdigit()] and "pipeline" in names
    assert entry.queries()["pipeline"](spark, SF).count() > 0


def test_run_against_brute_force(spark):
    """The five stages over all documents of the smallest tables, each redone without the operators (the language
    stage rejects texts without letters only: the model is sure about every document of these tables)."""
    import hashlib
    from collections import defaultdict

    import numpy as np
    import sentencepiece

    from spanlab.llm import piece_codec

    from .conftest import docs_of
    from .test_groups import brute_groups
    from .test_language_mixing_topk import brute_targets
    from .test_lines_passages import brute_lines

    rows = [(i, t, s) for i, t, _, s in docs_of() if any(c.isalpha() for c in t or "")]
    lines = brute_lines([(i, t) for i, t, _ in rows])
    rows = [(i, "\n".join(lines[i]), s) for i, _, s in rows]
    groups = brute_groups([(i, t) for i, t, _ in rows], 5)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    size = {i: len([w for w in t.split() if w]) for i, t, _ in rows}
    total = defaultdict(int)
    for i, _, s in rows:
        total[s] += size[i]
    targets, want = brute_targets(dict(total)), []
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    for s in total:
        budget, before = int(targets[s] + 0.5), 0
        for i, t, _ in sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(f"0:{r[0]}".encode()).hexdigest()):
            part = min(size[i], max(0, budget % total[s] - before))
            before += size[i]
            ids = sp.encode(t, add_bos=True, add_eos=True)
            one = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
            want += [one] * (budget // total[s] + (size[i] > 0 and 2 * part >= size[i]))
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(want)
