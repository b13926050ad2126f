import random

import pytest

from recsieve.operators.trees import tree_text, unread_blocks

SCHEMA = "page_id long, block_id long, parent_id long, pos long, text string"


def recursive(rows, first_page=None):
    """As a reader goes that asks for the children of each block."""
    children = {}
    for page, block, parent, pos, text in rows:
        children.setdefault((page, parent), []).append((pos, block, text))

    def read(page, parent):
        out, below = [], sorted(children[page, parent])
        for _, block, text in below[: first_page if parent is not None else None]:
            if text is not None:
                out.append(text)
            if (page, block) in children:
                out.append(read(page, block))
        return "\n".join(out)

    return sorted((page, read(page, None)) for page, parent in children if parent is None)


def result(spark, rows, first_page=None):
    return sorted(tuple(r) for r in tree_text(spark.createDataFrame(rows, SCHEMA).repartition(4), first_page).collect())


@pytest.mark.parametrize("depths", [(1, 3, 64), (1000,)])
def test_chains(spark, depths):
    rows = [(d, i, i - 1 if i else None, 0, f"t{i}") for d in depths for i in range(d)]
    assert result(spark, rows) == [(d, "\n".join(f"t{i}" for i in range(d))) for d in depths]


def test_random_trees(spark):
    rng = random.Random(3)
    rows = []
    for page in range(60):
        n = rng.randrange(1, 30)
        for i in range(n):
            parent = None if i == 0 or rng.random() < 0.1 else rng.randrange(max(0, i - rng.choice([1, 3, 30])), i)
            rows.append((page, i, parent, rng.randrange(4), rng.choice([None, None, "", f"p{page}b{i}"])))
    for first_page in (None, 1, 2):
        assert result(spark, rows, first_page) == recursive(rows, first_page)


def test_orphans_cycles_and_no_rows(spark):
    rows = [(1, 1, None, 0, "a"), (1, 2, 1, 0, "b"), (1, 3, 9, 0, "orphan"), (1, 4, 3, 0, "below it"), (1, 5, 6, 0, "x"), (1, 6, 5, 0, "y"), (1, 7, 6, 1, "below the cycle"), (1, 8, 8, 0, "own parent"), (2, 1, 2, 0, "no root"), (2, 2, 1, 0, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(spark, rows) == [(1, "a\nb")]
    assert sorted(tuple(r) for r in unread_blocks(df).collect()) == [(1, 3, "orphan"), (1, 4, "orphan"), (1, 5, "cycle"), (1, 6, "cycle"), (1, 7, "cycle"), (1, 8, "cycle"), (2, 1, "cycle"), (2, 2, "cycle")]
    assert tree_text(df.where("false")).count() == 0 and unread_blocks(df.where("false")).count() == 0
    assert result(spark, [(None, 1, None, 0, "n"), (None, 2, 1, 0, None)]) == [(None, "n\n")]
