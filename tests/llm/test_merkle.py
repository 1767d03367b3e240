import hashlib
import random
import zlib

from cases import documents, empty
from pyspark.sql import functions as F

from readloom.llm import merkle
from readloom.llm.places import placed
from readloom.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return hashed(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def up(level):
    return [hashed(*level[i : i + 8]) for i in range(0, len(level), 8)]


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(up(out[-1]))
    return out


def siblings(levels, at):
    for level in levels[:-1]:
        run = level[at - at % 8 : at - at % 8 + 8]
        yield at % 8, run
        at //= 8


def brute(rows, claim):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    lower = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        lower[lang] = levels_of([leaf(r) for r in trees[lang]])
    upper = levels_of([lower[x][-1][0] for x in order])
    out = []
    for place, lang in enumerate(order):
        for i, r in enumerate(trees[lang]):
            proof, own = [], leaf(claim(r))
            for slot, run in [*siblings(lower[lang], i), *siblings(upper, place)]:
                proof += run[:slot] + run[slot + 1 :]
                own = hashed(*run[:slot], own, *run[slot + 1 :])
            root = upper[-1][0]
            out.append((r[0], leaf(r), lower[lang][-1][0], root, hashed(*proof), own, own == root))
    return sorted(out, key=repr)


def tampered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def found(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.parquet(f"{path}/documents.parquet")
    return sorted((tuple(r) for r in QUERIES["op11_merkle"].run(spark, path).collect()), key=repr)


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    langs = ["en"] * 30 + ["de", "fr", None, "é", "zz"] + [f"l{i}" for i in range(9)]
    rows = [(i, rng.choice(["a", None]), rng.choice(langs), i % 7 or None, rng.choice(["Ab É", "ab", "", None])) for i in range(700)]
    rows += [rows[3]] * 5 + [(None, None, "en", 1, "X"), (None, None, "en", 1, "Y"), (1000, "s", "lone", 2, "Z")]
    rng.shuffle(rows)
    assert found(spark, rows, tmp_path) == brute(rows, tampered)


def test_one_branch_and_one_leaf(spark, tmp_path):
    for n in (1, 8, 65):
        rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
        assert found(spark, rows, tmp_path / str(n)) == brute(rows, tampered)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []
    built = merkle.manifest(empty(spark), [F.col("doc_id")])
    assert built.root is None and merkle.verified(built).count() == 0


def test_row_limit_comes_back(spark):
    before = spark.conf.get(merkle.ROW_LIMIT, None)
    built = merkle.manifest(documents(spark), [F.col(c) for c in ("doc_id", "text")])
    assert merkle.verified(built).where("not verified").isEmpty()
    assert spark.conf.get(merkle.ROW_LIMIT, None) == before


def test_a_wrong_leaf_does_not_verify(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(100)], claimed=1, place=2, tree=3)
    wrong = F.when(F.col("doc_id") == 37, merkle.leaf_of([F.lit("x")])).otherwise(merkle.leaf_of([F.col("doc_id"), F.col("text")]))
    built = merkle.manifest(docs, [F.col("doc_id"), F.col("text")], claimed=wrong)
    assert [r["id"] for r in merkle.verified(built, "claimed").where("not verified").collect()] == [37]


def test_places_and_running_digests(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, None, rng.randrange(50)]), i, rng.randrange(-(2**40), 2**40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, o long, x long").repartition(7)
    got = {(r["g"], r["o"]): (r["place"], r["before_x"]) for r in placed(df, ["g"], [F.col("o")], ("x",)).collect()}
    want, state = {}, {}
    for g, o, x in sorted(rows, key=lambda r: r[1]):
        n, bits = state.get(g, (0, 0))
        want[g, o] = (n, bits)
        state[g] = (n + 1, bits ^ x)
    assert got == want
