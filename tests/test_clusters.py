"""Clustering by identity against one-by-one clustering, and the choice of contigs against a plain walk through them."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from popspark.operators import alike
from popspark.operators import clusters as C


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def one_by_one(rows, identity, k, w, band):
    ids = {}
    for i, s in rows:
        ids[s or ""] = min(ids.get(s or "", i), i)
    order = sorted(ids, key=lambda s: (len(s), hashlib.md5(s.encode()).hexdigest()), reverse=True)
    reps, of = [], {}
    for s in order:
        best, seeds = None, dict(zip(*(x.tolist() for x in C.minimizers(s, k, w))))
        for r in reps:
            other = dict(zip(*(x.tolist() for x in C.minimizers(r, k, w))))
            shifts = Counter(other[x] - at for x, at in seeds.items() if x in other)
            if shifts and shifts.total() >= len(seeds) * identity ** (k + w) / 2:
                shift = max(shifts, key=lambda d: (shifts[d], -d))
                laid = r[max(0, shift - band) : max(0, shift + len(s) + band)]
                share = 1 - (distance(s, laid) - max(0, len(laid) - len(s))) / len(s)
                if share >= identity - 1e-9 and (best is None or share > best[0]):
                    best = share, r
        if best is None:
            reps.append(s)
        of[s] = best[1] if best else s
    return {(i, reps.index(of[s or ""]) + 1, ids[of[s or ""]]) for i, s in rows}


def made(seed, n=50):
    rng, out = random.Random(seed), []
    for _ in range(n):
        s = list(rng.choice(out)) if out and rng.random() < 0.7 else [rng.choice("ACGT") for _ in range(rng.randint(20, 60))]
        for _ in range(rng.randint(0, 7)):
            at = rng.randrange(len(s))
            s[at : at + 1] = rng.choice([[], [rng.choice("ACGTN")], [rng.choice("ACGT"), rng.choice("ACGT")]]) or ["A"] * (len(s) == 1)
        out.append("".join(s[rng.randint(0, 3) :]) or "A")
    return [(i, s) for i, s in enumerate([*out, *out[:5], "ACG", "", "N" * 20, "A" * 30, "A" * 33, None])]


@pytest.mark.parametrize("seed,identity,block", [(1, 0.9, 2), (2, 0.8, 1), (3, 0.8, 32)])
def test_clusters_are_those_of_going_one_by_one(spark, seed, identity, block):
    rows = made(seed)
    df = spark.createDataFrame(rows, "id int, seq string")
    got = C.cluster_sequences(df, identity, k=6, w=3, block=block, band=4).collect()
    assert len(got) == len(rows)
    assert {(r.id, r.cluster, r.rep_id) for r in got} == one_by_one(rows, identity, 6, 3, 4)


def test_no_sequences(spark):
    df = spark.createDataFrame([], "id int, seq string")
    assert C.cluster_sequences(df).collect() == []
    assert C.build_reference(df.withColumnRenamed("id", "contig")).collect() == []


def test_pairs_follow_their_forward(spark):
    rng = random.Random(4)
    fwd = "".join(rng.choice("ACGT") for _ in range(60))
    near = fwd[:30] + ("A" if fwd[30] != "A" else "C") + fwd[31:]
    other = "".join(rng.choice("ACGT") for _ in range(60))
    rows = [(1, fwd + "N" * 10 + "ACGT"), (2, fwd + "N" * 10 + "TTTT"), (3, near + "N" * 10 + "CC"), (4, other)]
    got = {r.read_id: r for r in C.cluster_table_rpe(spark.createDataFrame(rows, "read_id int, seq string"), 0.9).collect()}
    assert got[1].cluster == got[2].cluster == got[3].cluster != got[4].cluster
    assert (got[2].fwd, got[2].rev, got[4].rev) == (fwd, "TTTT", "")
    assert C.forward_identity(0.95) == 0.85 and C.forward_identity(0.85) == 0.8


def test_reference_and_sweep(spark):
    rows = [(f"s{s}", q, n) for s, q, n in [(1, "ACGTACGGTTACCAGT", 3), (2, "ACGTACGGTTACCAGT", 1), (1, "ACGTACGGTTACCAGA", 1), (2, "GGCATTTACGCGATAA", 2)]]
    uniq = spark.createDataFrame(rows, "sample string, seq string, n long")
    contigs = uniq.select(F.col("seq").alias("contig"), "seq").distinct()
    built = {r.seq for r in C.build_reference(contigs, 0.9).collect()}
    assert len(built) == 2 and "NGGCATTTACGCGATAAN" in built
    got = {(r.k1, r.k2, r.identity): r.contigs for r in C.sweep_reference(uniq, [1, 2], [1, 2], [0.9, 1.0]).collect()}
    assert got == {(1, 1, 0.9): 2, (1, 1, 1.0): 3, (1, 2, 0.9): 1, (1, 2, 1.0): 1, (2, 1, 0.9): 2, (2, 1, 1.0): 2, (2, 2, 0.9): 0, (2, 2, 1.0): 0}


def test_all_cells_of_a_sweep_are_those_of_building_each(spark):
    rng, rows = random.Random(3), []
    for i, s in made(21, 40):
        rows += [(f"s{x}", (s or "")[:50], rng.randint(1, 4)) for x in rng.sample(range(6), rng.randint(1, 5))]
    uniq = spark.createDataFrame(rows, "sample string, seq string, n long").groupBy("sample", "seq").agg(F.sum("n").alias("n"))
    got = {(r.k1, r.k2, r.identity): r.contigs for r in C.sweep_reference(uniq, [3, 1, 2], [1, 2, 3, 9], [0.8, 0.86, 0.9, 1.0], shortest=4).collect()}
    assert len(got) == 48
    held = {}
    for r in uniq.collect():
        held.setdefault(r.seq, []).append(r.n)
    for (k1, k2, identity), contigs in got.items():
        kept = [(s, s) for s, n in held.items() if sum(x >= k1 for x in n) >= k2]
        long = one_by_one_without_seeds([x for x in kept if len(x[1]) >= 4], identity)
        assert contigs == len({c for _, c, _ in long}) + sum(len(s) < 4 for s, _ in kept), (k1, k2, identity)


def walk(rows, limit):
    """seq of one cluster, its rows (ordinal, seq, freq, fwd, rev) taken in order."""
    first, second, forward, long_one, kept, reads = "", "", 0, 0, 0, 0
    for _, seq, freq, fwd, rev in sorted(rows):
        n = len(seq)
        if fwd and rev and n > limit:
            first, long_one = seq, n
        elif fwd and (rev or n > forward):
            first, forward = seq, n
        elif (freq > reads and n >= kept) or (freq == reads and n > kept):
            second, kept, reads = seq, n, freq
    return second + "N" * 10 + first if kept > long_one else first


def test_best_contigs(spark):
    rng, rows = random.Random(5), []
    for cluster in range(60):
        for ordinal in range(rng.randint(1, 9)):
            fwd, rev = rng.choice([(True, False), (False, True), (True, True)])
            rows.append((cluster, ordinal, "".join(rng.choice("ACGT") for _ in range(rng.randint(3, 12))), rng.randint(1, 4), fwd, rev))
    got = C.best_contigs(spark.createDataFrame(rows, "cluster int, ordinal int, seq string, freq int, fwd boolean, rev boolean"), 7).collect()
    assert {r.cluster: r.seq for r in got} == {c: walk([r[1:] for r in rows if r[0] == c], 7) for c in range(60)} and len(got) == 60


def edits_inside(short, long):
    """Edits that make short a part of long, by the plain table."""
    row = [0] * (len(long) + 1)
    for i, x in enumerate(short, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(long, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return min(row)


def one_by_one_without_seeds(rows, identity):
    ids, reps, of = {}, [], {}
    for i, s in rows:
        ids[s or ""] = min(ids.get(s or "", i), i)
    for s in sorted(ids, key=lambda s: (len(s), hashlib.md5(s.encode()).hexdigest()), reverse=True):
        near = [(edits_inside(s, r) / len(s), at) for at, r in enumerate(reps) if s]
        best = min([x for x in near if x[0] <= 1 - identity + 1e-9], default=None)
        of[s] = reps[best[1]] if best else s
        if best is None:
            reps.append(s)
    return {(i, reps.index(of[s or ""]) + 1, ids[of[s or ""]]) for i, s in rows}


def test_edits_inside():
    rng = random.Random(6)
    pairs = [("".join(rng.choice("ACGé") for _ in range(rng.choice([1, 5, 63, 64, 65, 130]))), "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 7, 64, 150])))) for _ in range(60)]
    pairs += [(x[3:70] + "TT", x) for x, _ in pairs if len(x) > 60]
    assert C.least_edits([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [edits_inside(*p) for p in pairs]


def test_long_ones_are_ruled_out_by_blocks_only_if_they_are_far():
    rng, pairs = random.Random(7), []
    for n in (10, 250, 300, 400, 700):
        s = "".join(rng.choice("ACGT") for _ in range(n))
        near = "".join(rng.choice("ACGT") if rng.random() < 0.1 else c for c in s)
        pairs += [(s, "GG" + near + "AA"), (s, s), (s, "".join(rng.choice("ACGT") for _ in range(n + 50))), (s, "")]
    short, long = [a for a, _ in pairs], [b for _, b in pairs]
    most = C.np.array([C.allowed_edits(len(a), 0.9) for a in short])
    want, got = C.least_edits(short, long), C.edits_up_to(short, long, most)
    assert (got[want <= most] == want[want <= most]).all() and (got[want > most] > most[want > most]).all()


def test_no_true_pair_has_more_words_missing_than_the_edits_spoil():
    rng, pairs = random.Random(9), []
    for _ in range(300):
        s = [rng.choice("ACGTN") for _ in range(rng.choice([3, 5, 20, 90]))]
        near = list(s)
        for _ in range(rng.randint(0, len(s) // 4)):
            at = rng.randrange(len(near))
            near[at : at + 1] = rng.choice([[], [rng.choice("ACGT")], [near[at], rng.choice("ACGT")]])
        pairs.append(("".join(s), "GG" + "".join(near) + "TA"))
    edits = C.least_edits([a for a, _ in pairs], [b for _, b in pairs])
    short, long = [a for a, _ in pairs], [b for _, b in pairs]
    assert (C.missing_words(short, long) <= 5 * edits).all() and not (C.missing_words(short, long[::-1]) <= 5 * edits).all()
    words = [[x[i : i + 5].replace("N", "A") for i in range(len(x) - 4)] for x in short[:20] + long[:20]]
    want = [sum((Counter(a) - Counter(b)).values()) for a, b in zip(words[:20], words[20:])]
    assert C.missing_words(short[:20], long[:20]).tolist() == want and C.missing_words([], []).tolist() == []
    assert C.missing_words(["AC", ""], ["", "A"]).tolist() == [0, 0]


def test_short_sequences_are_like_no_other(spark):
    rows = [(1, "ACGTACGTAA"), (2, "ACG"), (3, "ACG"), (4, "ACGTACGT"), (5, "ACGTACGTA")]
    df = spark.createDataFrame(rows, "id int, seq string")
    assert {r.id: r.rep_id for r in C.cluster_sequences(df, 0.9, shortest=9).collect()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 1}
    assert {r.rep_id for r in C.cluster_sequences(df, 0.9).collect()} == {1}


@pytest.mark.parametrize("seed,identity,block", [(11, 0.9, 2), (12, 0.8, 32), (13, 0.8, 3)])
def test_no_pair_is_missed(spark, seed, identity, block):
    rows = made(seed, 40)
    got = C.cluster_sequences(spark.createDataFrame(rows, "id int, seq string"), identity, block=block).collect()
    assert {(r.id, r.cluster, r.rep_id) for r in got} == one_by_one_without_seeds(rows, identity) and len(got) == len(rows)


@pytest.mark.parametrize("identity", [0.8, 0.9])
def test_planted_pairs_of_all_lengths_are_found(spark, identity):
    rng, rows = random.Random(8), []
    for n in (30, 60, 150, 400):
        for _ in range(15):
            s = [rng.choice("ACGT") for _ in range(n)]
            near = list(s)
            for at in rng.sample(range(n), C.allowed_edits(n, identity)):
                near[at] = rng.choice([x for x in "ACGT" if x != s[at]])
            rows += [(n, "".join(s)), (n, "".join(near))]
    df = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(rows)], "id int, seq string")
    of = {r.id: r.cluster for r in C.cluster_sequences(df, identity).collect()}
    assert sum(of[i] == of[i + 1] for i in range(0, len(rows), 2)) == len(rows) // 2


def test_pairs_of_small_blocks_are_those_of_one_block(spark):
    nodes = C.in_order(spark.createDataFrame(made(17, 30), "id int, seq string")).where("n > 0")
    found = lambda **sizes: sorted(map(tuple, C.Pairs(nodes, 0.8, **sizes).of(nodes, nodes).collect()))
    small = C.Pairs(nodes, 0.8, late_bases=60, early_bases=100, hits=10_000)
    assert all(len(cuts) > 0 for cuts in small.cuts) and found() == found(late_bases=60, early_bases=100, hits=10_000) != []


def test_no_sequence_is_shuffled_once_for_each_block_of_the_others(spark):
    nodes = C.in_order(spark.createDataFrame(made(15), "id int, seq string")).where("n > 0")
    found = C.Pairs(nodes, 0.8, late_bases=60, early_bases=100, hits=10_000).of(nodes, nodes)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join Inner" in plan and "shuffle_replicate_nl" in plan


def test_a_sweep_writes_no_link_for_each_cell_nor_between_blocks(spark, monkeypatch):
    rng, sizes, keep = random.Random(6), [], C.written
    base, rows = [rng.choice("ACGT") for _ in range(50)], []
    for _ in range(60):  # near copies of one sequence, all in all cells
        s = list(base)
        s[rng.randrange(50)] = rng.choice("ACGT")
        rows += [(f"s{x}", "".join(s), 9) for x in range(4)]
    uniq = spark.createDataFrame(rows, "sample string, seq string, n long").distinct()
    n = uniq.select("seq").distinct().count()

    def counted(df):
        out = keep(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(C, "written", counted)
    cells = [1, 2, 3], [1, 2, 3, 4], [0.8, 0.86, 0.9, 0.98, 1.0]
    got = {tuple(r) for r in C.sweep_reference(uniq, *cells, block=10, first=10).collect()}
    assert max(sizes) <= n * 10
    assert got == {tuple(r) for r in C.sweep_reference(uniq, *cells).collect()}
    assert {r[3] for r in got if r[2] == 1.0} == {n} and {r[3] for r in got if r[2] < 0.9} == {1}


def test_a_sweep_in_small_blocks_is_that_in_one(spark):
    rng, rows = random.Random(3), []
    for i, s in made(23, 40):
        rows += [(f"s{x}", s, rng.randint(1, 4)) for x in rng.sample(range(6), rng.randint(1, 5))]
    uniq = spark.createDataFrame(rows, "sample string, seq string, n long").groupBy("sample", "seq").agg(F.sum("n").alias("n"))
    swept = lambda **settings: sorted(map(tuple, C.sweep_reference(uniq, [1, 2, 3], [1, 2, 3], [0.8, 0.86, 0.9, 1.0], shortest=4, **settings).collect()))
    assert swept(block=7, first=3) == swept() and len(swept()) == 36


@pytest.mark.parametrize("identity,n", [(0.8, 200), (0.8, 60), (0.9, 300), (0.9, 100)])
def test_few_pairs_of_unlike_sequences_come_to_their_edits(identity, n):
    """Texts of few syllables share many short runs; all but true pairs are ruled out near these."""
    rng, out = random.Random(9), []
    syllables = ["".join(rng.choice("ACGT") for _ in range(rng.randint(2, 4))) for _ in range(30)]
    for _ in range(120):
        s = "".join(rng.choice(syllables) for _ in range(n))[: n + rng.randint(0, 5)]
        out += [s, s[:20] + s[21:]] if len(out) < 10 else [s]
    out.sort(key=lambda s: (-len(s), s))
    found = [set(zip(x["late"], x["early"])) for x in alike._near(alike._Late(out, range(1, len(out) + 1), identity), out, list(range(1, len(out) + 1)))]
    got = set().union(*found)
    pairs = [(i, j) for i in range(len(out)) for j in range(i)]
    edits = C.least_edits([out[i] for i, _ in pairs], [out[j] for _, j in pairs])
    want = {(i + 1, j + 1) for (i, j), e in zip(pairs, edits) if e <= C.allowed_edits(len(out[i]), identity)}
    assert want <= got and len(got) <= len(want) + len(out)


@pytest.mark.parametrize("identity", [0.8, 0.9])
def test_repeats_of_long_sequences_hide_no_pair(identity):
    rng, out = random.Random(10), []
    for _ in range(7):
        s = "".join((word * 60)[: rng.randint(30, 300)] for word in ("".join(rng.choice("ACGT") for _ in range(rng.randint(1, 6))) for _ in range(12)))
        near = list(s[rng.randint(0, 200) :])
        for at in rng.sample(range(len(near)), int((1 - identity) * len(near) * rng.choice([0.1, 0.9]))):
            near[at] = rng.choice("ACGT")
        out += [s, "".join(near)]
    out.sort(key=lambda s: (-len(s), s))
    keys = list(range(1, len(out) + 1))
    got = {(r.late, r.early): r.edits for x in alike._verified(alike._near(alike._Late(out, keys, identity), out, keys)) for r in x.itertuples()}
    pairs = [(i, j) for i in range(len(out)) for j in range(i)]
    edits = [alike._by_diagonals(out[i], out[j], C.allowed_edits(len(out[i]), identity)) for i, j in pairs]
    assert got == {(i + 1, j + 1): e for (i, j), e in zip(pairs, edits) if e <= C.allowed_edits(len(out[i]), identity)} and len(got) >= 6


def test_edits_by_diagonals_are_the_least():
    rng = random.Random(11)
    for _ in range(60):
        s = "".join(rng.choice("ACGé") for _ in range(rng.choice([1, 9, 70, 200])))
        near = "".join(rng.choice(["", "A", "CG"]) if rng.random() < 0.1 else c for c in s)
        long = rng.choice(["", "GGA"]) + near + rng.choice(["", "AC" * 9])
        want, most = edits_inside(s, long), rng.choice([0, 3, len(s) // 4])
        assert alike._by_diagonals(s, long, most) == want if want <= most else alike._by_diagonals(s, long, most) > most
