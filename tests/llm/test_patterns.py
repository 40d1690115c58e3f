"""The mix does not depend on how many sets of sources there are."""

import random

from tidewire.llm import mixing


def test_many_sets_mix_as_few(spark):
    names = "abcdef"
    docs = [(i, "word " * 20, sorted(random.Random(i).sample(names, 3))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source array<string>")
    targets = spark.createDataFrame([(s, 1 / 6, 2) for s in names], "source string, target_share double, max_repeats int")
    few, many = (sorted(map(tuple, mixing.mixed(df, targets, most_patterns=n).collect())) for n in (100_000, 4))
    assert few == many and few
