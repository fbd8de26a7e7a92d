from cases import base_measures, by_key, documents, rows_of, TEXTS

from replyloom.llm import quality_rules as Q


def test_measures_equal_a_plain_count(spark):
    ledger = Q.rule_ledger(documents(spark))
    assert rows_of(ledger.select("doc_id", *Q.MEASURES)) == by_key((k, *base_measures(t)) for k, t in TEXTS)


def test_bits_say_which_rule_failed(spark):
    ledger = {r.doc_id: r for r in Q.rule_ledger(documents(spark)).collect()}
    names = lambda key: {rule.name for i, rule in enumerate(Q.RULES) if ledger[key].failures >> i & 1}
    assert names(2) == names(3) == {"too_few_words"}
    assert names(5) == {"repeated_windows"}  # the long text repeats its cycle
    assert "repeated_windows" in names(7) and "too_few_words" in names(7)
    assert names(11) == {"too_few_words", "long_words"}


def test_policies_are_masks(spark):
    kept = Q.apply_policies(Q.rule_ledger(documents(spark)))
    for row in kept.collect():
        base = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.kept_base == (not base)
        assert row.kept_v2 <= row.kept_v1 <= row.kept_base


def test_ablation_equals_judging_again(spark):
    ledger = Q.rule_ledger(documents(spark))
    rows = ledger.collect()
    table = {(r.version, r.rule): r for r in Q.ablations(ledger).collect()}
    policy = Q.POLICIES[-1]
    for name in policy.rules:
        bit = 1 << [r.name for r in Q.RULES].index(name)
        others = Q.mask_of(policy) & ~bit
        found = table[policy.version, name]
        assert found.documents == len(rows)
        assert found.kept == sum(r.failures == 0 for r in rows)
        assert found.kept_without == sum(r.failures & others == 0 for r in rows)
        assert found.failing == sum(r.failures & bit != 0 for r in rows)
        assert found.only_this == sum(r.failures == bit for r in rows)


def test_empty_table(spark):
    ledger = Q.rule_ledger(documents(spark, []))
    assert ledger.collect() == [] and Q.ablations(ledger).collect() == []
