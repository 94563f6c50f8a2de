import pytest

from conftest import rows
from strainwise.operators import annotations as an, variants as va

FAPG = "variant_id int, gene_db_crossref_id int, predicted_effect string, nucleotidic_annotation string, proteic_annotation string, distance_to_reference long"
VARIANT = "variant_id int, chromosome string, position int, reference_nucleotide string, alternative_nucleotide string"
LONG = "variant_id int, effect string, gene_id string, dist string, type string, value string"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("p.AspGly95LeuSer", {("p.Asp95Leu", "95", "missense_variant"), ("p.Gly96Ser", "96", "missense_variant")}),
        ("p.AspGlySer95LeuGlyGln", {("p.Asp95Leu", "95", "missense_variant"), ("p.Ser97Gln", "97", "missense_variant")}),
        ("p.AspTer95LeuTrp", {("p.Asp95Leu", "95", "missense_variant"), ("p.Ter96Trp", "96", "stop_lost")}),
        ("p.AspGly95LeuTer", {("p.Asp95Leu", "95", "missense_variant"), ("p.Gly96*", "96", "stop_gained")}),
        ("p.Asp95Leu", {("p.Asp95Leu", "7", "x")}),
    ],
)
def test_multi_missense(frame, value, expected):
    out = an.split_multi_missense(frame([(1, "x", "G", "7", "proteic", value)], LONG))
    assert {(r.value, r.dist, r.effect) for r in out.collect()} == expected


def test_stop_retained(frame):
    df = frame(
        [("stop_retained_variant", "p.Ala5Ter"), ("stop_retained_variant", "p.Ter5Ter"), ("stop_retained_variant", "p.Ala5Gly"), ("stop_gained", "p.Ala5Ter"), ("missense_variant", "p.Ala5Ter")],
        "effect string, hgvs_p string",
    )
    assert [tuple(r) for r in an.fix_stop_retained(df).collect()] == [
        ("stop_gained", "p.Ala5*"), ("stop_retained_variant", "p.Ter5Ter"), ("missense_variant", "p.Ala5Gly"), ("stop_gained", "p.Ala5*"), ("missense_variant", "p.Ala5Ter"),
    ]


def test_hgvs_repairs(frame):
    df = frame([(1, "e", "G", "1", "proteic", v) for v in ("p.465", "p.ValAlaGly1?", "p.Val1?", "p.Ala4Gly")], LONG)
    assert [r.value for r in an.fix_hgvs(df).collect()] == ["p.=", "p.Val1?", "p.Val1?", "p.Ala4Gly"]


def test_wrong_field_count_stops(frame):
    df = frame([(1, "ANN=A|b|c")], "variant_id int, annotation string")
    with pytest.raises(Exception, match="without 16 fields"):
        an.parse_effect_annotations(df).collect()


def test_empty_input_gives_empty_result(frame):
    assert an.stage_annotations(frame([], "variant_id int, annotation string")).collect() == []


def test_decomposition_rebuilds_the_alternative(frame):
    variant = frame([(1, "c", 10, "ACGT", "TCAT"), (2, "c", 10, "A", "T"), (3, "c", 12, "G", "A"), (4, "d", 10, "A", "T"), (5, "c", 20, "AC", "GT")], VARIANT)
    assert rows(va.decompose_mnv(variant)) == [(1, 2), (1, 3)]
    letters = va.substituted_letters(variant.where("variant_id = 1")).collect()
    text = list("ACGT")
    for r in letters:
        assert text[r.position - 10] == r.reference_nucleotide
        text[r.position - 10] = r.alternative_nucleotide
    assert "".join(text) == "TCAT"
    assert rows(va.derive_missing_snvs(variant)) == [("c", 20, "A", "G"), ("c", 21, "C", "T")]


def test_deletion_over_start_codon_keeps_the_coding_row(frame):
    link = frame([(1, 1), (1, 2), (1, 3)], "variant_id int, annotation_id int")
    annotation = frame(
        [(1, 7, "upstream_gene_variant", "c.-8_1del", 8), (2, 7, "frameshift_variant&start_lost", "c.-8_1del", 1), (3, 107, "frameshift_variant&start_lost", "p.Met1fs", 1)],
        "annotation_id int, reference_db_crossref_id int, predicted_effect string, hgvs_value string, distance_to_reference int",
    )
    dbxref = frame([(7, "Gene", "g"), (107, "Protein", "p")], "dbxref_id int, dbname string, accession string")
    protein = frame([(107, 7)], "protein_db_crossref_id int, gene_db_crossref_id int")
    out = va.formatted_annotation_per_gene(link, annotation, dbxref, protein)
    assert rows(out) == [(1, 7, "frameshift_variant&start_lost", "c.-8_1del", "p.Met1fs", 1)]


def categories(frame, fapg_rows, variant_rows, promoter_rows=(), tier_rows=((1, 1, 1),), unpool=False):
    fapg, variant = frame(fapg_rows, FAPG), frame(variant_rows, VARIANT)
    tier = frame(list(tier_rows), "gene_db_crossref_id int, drug_id int, tier int")
    promoter = frame(list(promoter_rows), "gene_db_crossref_id int, start int, end int")
    mnv = va.decompose_mnv(variant)
    ranked = va.ranked_variant_categories(
        fapg, va.pure_synonymous_mnv(fapg, tier, mnv), tier, variant, mnv, promoter, va.missense_codons(fapg, variant, tier), unpool
    )
    return ranked


def named(df):
    return {(r.variant_id, r.variant_category, r.predicted_effect) for r in va.tiered_variant_categories(df).collect()}


def test_category_cases(frame):
    effects = [
        (1, "frameshift_variant", "p.Ala5fs", "p.Ala5fs", "frameshift"),
        (2, "frameshift_variant", "p.Ter5fs", "p.Ter5ext*?", "stop_lost"),
        (3, "stop_lost&frameshift_variant", "p.Ala5fs", "p.Ala5fs", "frameshift"),
        (4, "stop_lost", "p.Ter5Ala", "p.Ter5Ala", "stop_lost"),
        (5, "start_lost&frameshift_variant", "p.Val1?", "p.Val1?", None),
        (6, "stop_gained&frameshift_variant", "p.Ala5fs", "p.Ala5*", "stop_gained"),
        (7, "feature_ablation", None, "deletion", "feature_ablation"),
        (8, "disruptive_inframe_insertion", "p.Thr4dup", "p.Thr4dup", "inframe_insertion"),
        (9, "conservative_inframe_insertion", "p.Thr4dup", "p.Thr4dup", "inframe_insertion"),
        (10, "initiator_codon_variant&non_canonical_start_codon", "p.Met1Met", "c.x", "initiator_codon_variant"),
        (11, "start_lost", "p.Val1?", "p.Met1?", "start_lost"),
    ]
    wanted = {(i, c, e) for i, _, _, c, e in effects if e} | {(5, "p.Val1?", "start_lost")}
    wanted = {(i, "p.Met1?" if e == "start_lost" and i == 5 else c, e) for i, c, e in wanted}
    # frameshift with start_lost: the start rule comes before the frameshift rule
    out = categories(frame, [(i, 1, e, "c.x", p, 5) for i, e, p, _, _ in effects], [(i, "c", i, "A", "T") for i, *_ in effects])
    assert named(out) == wanted


def test_unpooled_frameshift_uses_the_nucleotide_text(frame):
    out = categories(frame, [(1, 1, "frameshift_variant", "c.5del", "p.Ala2fs", 5)], [(1, "c", 1, "A", "T")], unpool=True)
    assert named(out) == {(1, "c.5del", "frameshift")}


def test_missense_with_synonymous_neighbour(frame):
    variant = [(1, "c", 10, "ACGT", "TCAA"), (2, "c", 10, "A", "T"), (3, "c", 13, "T", "A")]
    fapg = [
        (1, 1, "missense_variant", "c.10_13delACGTinsTCAA", "p.Thr4Ser", 12),
        (2, 1, "missense_variant", "c.10A>T", "p.Thr4Ser", 10),
        (3, 1, "synonymous_variant", "c.13T>A", "p.Ala5Ala", 13),
    ]
    out = named(categories(frame, fapg, variant))
    assert {x for x in out if x[0] == 1} == {(1, "p.Thr4Ser", "missense_variant"), (1, "c.13T>A", "synonymous_variant")}


def test_pure_synonymous_substitution_is_decomposed(frame):
    variant = [(1, "c", 10, "AC", "TG"), (2, "c", 10, "A", "T"), (3, "c", 11, "C", "G"), (4, "c", 20, "AC", "TG"), (5, "c", 20, "A", "T")]
    fapg = [
        (1, 1, "synonymous_variant", "c.10_11delACinsTG", "p.=", 10), (2, 1, "synonymous_variant", "c.10A>T", "p.=", 10), (3, 1, "synonymous_variant", "c.11C>G", "p.=", 11),
        (4, 1, "synonymous_variant", "c.20_21delACinsTG", "p.=", 20), (5, 1, "missense_variant", "c.20A>T", "p.Ala7Gly", 20),
    ]
    out = named(categories(frame, fapg, variant))
    assert {x[1] for x in out if x[0] == 1} == {"c.10A>T", "c.11C>G"}
    assert {x[1] for x in out if x[0] == 4} == {"c.20_21delACinsTG"}


def test_promoter_filter_and_overlap(frame):
    fapg = [(1, 1, "upstream_gene_variant", "c.-5A>T", None, 5), (1, 2, "upstream_gene_variant", "c.-9A>T", None, 9), (2, 1, "upstream_gene_variant", "c.-99A>T", None, 99)]
    out = categories(frame, fapg, [(1, "c", 1, "A", "T"), (2, "c", 2, "A", "T")], [(1, 1, 10), (2, 1, 10)], [(1, 1, 2), (2, 1, 1)])
    assert named(out) == {(1, "c.-9A>T", "upstream_gene_variant")}
    symbol = frame([(1, "one"), (2, "two")], "gene_db_crossref_id int, resolved_symbol string")
    report = va.overlap_report(out, symbol).collect()
    assert {(r.resolved_symbol, r.gene_rank, r.overlapping_gene) for r in report} == {("one", 2, 1), ("two", 1, 1)}


def test_deletion_keeps_every_gene(frame):
    fapg = [(1, 1, "feature_ablation", "c.del", None, 1), (1, 2, "feature_ablation", "c.del", None, 1)]
    out = va.tiered_variant_categories(categories(frame, fapg, [(1, "c", 1, "AAAA", "A")], (), [(1, 1, 1), (2, 1, 1)]))
    assert {r.gene_db_crossref_id for r in out.collect()} == {1, 2}
