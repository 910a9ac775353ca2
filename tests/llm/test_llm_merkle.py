import hashlib

from pyspark.sql import functions as F

from tidemark.llm import common, merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        at //= 16
    return out


def plain(rows):
    """(doc_id, leaf) -> (subroot, root, proof, folded root) for rows (doc_id, source, text, other digest)."""
    groups = {}
    for doc_id, source, text, other in rows:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, sha(field(doc_id) + field(source) + field(text)), other))
    for held in groups.values():
        held.sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in held]) for s, held in groups.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for s, held in groups.items():
        for at, (known, doc_id, leaf, other) in enumerate(held):
            way = siblings(trees[s], at) + siblings(top, order.index(s))
            folded = other or leaf
            for left, right in way:
                folded = sha(left + folded + right)
            proof = "".join(left + right for left, right in way)
            out.append((doc_id if known else None, leaf, trees[s][-1][0], top[-1][0], proof, folded))
    return sorted(out, key=repr)


def held(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, other string")
    df = merkle.leaves(df.withColumn("leaf", F.lit("clash")), ["doc_id", "source", "text"], ["doc_id", "source", "other", "leaf"])
    found = merkle.manifest(df.withColumn("root", F.lit("clash")), replacement="other")
    assert found.columns == ["doc_id", "source", "other", "leaf", "subroot", "root", "proof", "folded_root"]
    return sorted(map(tuple, found.drop("source", "other").collect()), key=repr)


def test_manifest_equals_plain_trees_with_a_hot_group_of_several_blocks(spark):
    rows = [(i, None if i % 17 == 0 else f"s{i % 3}" if i < 300 else "é", f"t{i}", sha("x") if i % 11 == 0 else None) for i in range(5000)]
    assert held(spark, rows) == plain(rows)


def test_more_sources_than_one_run_null_ids_ties_and_repeated_rows(spark):
    rows = [(i, f"s{i}", None, None) for i in range(40)]
    rows += [(None, "a", "", None), (None, "a", "x", sha("y")), (7, "a", "x", None), (7, "a", "x", None), (7, "a", "z", None)]
    assert held(spark, rows) == plain(rows)


def test_a_lone_leaf_is_its_own_root_and_an_empty_table_has_none(spark):
    ((_, leaf, subroot, root, proof, folded),) = held(spark, [(1, None, "long " * 9000, None)])
    assert leaf == subroot == root == folded and proof == ""
    assert held(spark, []) == []


def test_folding_reads_kept_states_and_right_siblings_only():
    digests = [sha(str(i)) for i in range(40)]
    levels = merkle._levels(digests, 40)
    ways = merkle._ways(digests, levels, [], [])
    folds = [merkle.fold(sha("new"), [(state, right) for _, right, state in way]) for way in ways]
    assert folds == [tree(digests[:i] + [sha("new")] + digests[i + 1 :])[-1][0] for i in range(40)]


def test_indexed_numbers_all_rows_in_order_whatever_their_ties(spark):
    df = common.stored(spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.lit(0).alias("index")), "t")
    rows = sorted(map(tuple, common.indexed(df, [F.col("k").desc(), "id"]).select("index", "k", "id").collect()))
    assert [r[0] for r in rows] == list(range(1000))
    assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (-r[0], r[1]))
    assert common.indexed(df.limit(0), ["k"]).count() == 0
