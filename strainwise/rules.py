"""Rule tables: fixed values that results depend on, kept as plain text.

Each table turns into a small literal DataFrame through :func:`rule_frame`.  Its
size is fixed here in the source, so these are the only frames the operators
broadcast unconditionally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------- thresholds (fixed values)
MIN_DEPTH = 15
MIN_COVERAGE_20X = 0.95
MIN_COVERAGE_10X = 0.95
MIN_FRACTION = 0.25
MIN_FRACTION_RIBOSOMAL = 0.5
CLEAR_FRACTION = 0.75
MIN_QUALITY_NEUTRAL = 1000
NEUTRAL_THRESHOLD = 0.1
SITE_FREQUENCY = (0.01, 0.99)
REPEAT_PADDING = 50
LONGEST_DELETION = 100000
BATCH_SIZE = 5000
DEFAULT_TAXON = 1773
RPOB_CODONS = (426, 452)
CALLERS = ("freebayes", "delly")
READY_STATUS = "Uploaded to S3"

# --------------------------------------------------------------------------- phenotypes (fixed values)
MEDIUM_ORDER = ["Middlebrook7H10", "LJ", "Middlebrook7H11", "Agar", "MGIT", "MODS", "BACTEC460"]
CATEGORY_ORDER = [
    "WHO_current",
    "non_WHO_CC_SR",
    "WHO_past",
    "WHO_undefined",
    "non_WHO_CC_R",
    "non_WHO_CC_S",
    "CRyPTIC_MIC",
    "MYCOTB_MIC",
]
UNUSABLE_CATEGORIES = ["to_be_excluded", "non_WHO_CC"]
POOLED_DRUGS = [("Ofloxacin", "Levofloxacin"), ("Prothionamide", "Ethionamide")]
CUTOFF_MEDIA = ["UKMYC6", "UKMYC5", "MGIT", "LJ", "7H10", "7H11", "MYCOTB"]
MICRODILUTION_PLATES = ["UKMYC6", "UKMYC5", "MYCOTB"]
COMPLETE_PANEL_PLATES = ["MGIT", "LJ", "7H10", "7H11"]
NOT_ON_MYCOTB = ["Capreomycin", "Cycloserine", "Para-Aminosalicylic Acid", "Rifabutin", "Streptomycin"]
IMPOSSIBLE_MIC = [("MYCOTB", "Isoniazid", "[0.08,0.08]")]
# plate, drug; the two UKMYC plates are allowed for every drug
PLATES_FOR_ALL_DRUGS = ["UKMYC5", "UKMYC6"]
PLATE_DRUGS = [
    ("MYCOTB", "Amikacin"),
    ("7H11", "Bedaquiline"),
    ("MGIT", "Bedaquiline"),
    ("MGIT", "Clofazimine"),
    ("MYCOTB", "Ethambutol"),
    ("MYCOTB", "Isoniazid"),
    ("7H10", "Linezolid"),
    ("MGIT", "Linezolid"),
    ("MGIT", "Moxifloxacin"),
    ("7H11", "Moxifloxacin"),
    ("MYCOTB", "Moxifloxacin"),
    ("MYCOTB", "Ofloxacin"),
    ("MYCOTB", "Rifampicin"),
    ("LJ", "Streptomycin"),
    ("MGIT", "Pretomanid"),
]
PLATE_LABELS = [("Sensititre MYCOTB", "MYCOTB"), ("Sensititre Custom AST Plates YUKMYC5", "UKMYC5")]
OVERVIEW_ORDER = ["WHO", "not-WHO", "ALL", "CC", "CC-ATU"]

# --------------------------------------------------------------------------- variant effects (fixed values)
SILENT_EFFECTS = ["synonymous_variant", "initiator_codon_variant", "stop_retained_variant"]
FLANKING_EFFECTS = ["upstream_gene_variant", "downstream_gene_variant"]
DECOMPOSED_EFFECTS = [
    "upstream_gene_variant",
    "synonymous_variant",
    "missense_variant",
    "non_coding_transcript_exon_variant",
]
LOSS_EFFECTS = ["start_lost", "stop_gained", "frameshift", "feature_ablation"]
DELETION_EFFECTS = ["deletion", "feature_ablation", "frameshift", "inframe_deletion"]
DROPPED_EFFECTS = [
    "intergenic_region",
    "gene_fusion",
    "bidirectional_gene_fusion",
    "chromosome_number_variation",
]
ABLATIONS = ["feature_ablation", "transcript_ablation"]
LOSS_PATTERN = "stop_gained|start_lost|frameshift_variant"
ANNOTATION_FIELDS = [
    "allele",
    "effect",
    "impact",
    "gene_name",
    "gene_id",
    "feature_type",
    "feature_id",
    "biotype",
    "rank",
    "hgvs_c",
    "hgvs_p",
    "cdna_len",
    "cds_len",
    "protein_len",
    "distance",
    "warning",
]
REPEAT_GENE = r"^P?PE([_-]PGRS)?[0-9]+$"
REPEAT_PRODUCTS = ["transposas", "PE-PGRS"]
NUCLEOTIDE_CODES = [("A", 1), ("C", 2), ("G", 3), ("T", 4)]
# Two deletions at the end of fbiC that leave the protein unchanged: position, reference, alternative.
LISTED_VARIANTS = [
    (1305494, "CGGCCTAGCCCCGGCGACGATGCCGGGTCGCGGGATGCGGCCCGTTGAGGAGCGGGGCAATCT", "C"),
    (
        1305494,
        "CGGCCTAGCCCCGGCGACGATGCCGGGTCGCGGGATGCGGCCCGTTGAGGAGCGGGGCAATCT"
        "GGCCTAGCCCCGGCGACGATGCCGGGTCGCGGGATGCGGCCCGTTGAGGAGCGGGGCAATCT",
        "C",
    ),
]

# --------------------------------------------------------------------------- known markers (fixed values)
# drug | gene | exact changes | pattern | first distance | last distance (ranges skip synonymous changes)
KNOWN_MARKERS = [
    ("Isoniazid", "inhA", "c.-777C>T p.Ser94Ala c.-778A>G c.-770T>C c.-770T>A c.-154G>A", None, None, None),
    ("Isoniazid", "katG", "", r"^p\.Ser315", None, None),
    ("Rifampicin", "rpoB", "p.Val170Phe p.Ile491Phe", None, 1278, 1356),
    (
        "Ethambutol",
        "embB",
        "p.Met306Ile p.Met306Leu p.Met306Val p.Asp354Ala p.Gly406Ala p.Gly406Cys p.Gly406Asp p.Gly406Ser p.Gln497Arg",
        None,
        None,
        None,
    ),
    ("Pyrazinamide", "pncA", "c.-11A>G", r"^(?!c\.)(?!p\.Ile6Leu$)(?!p\.Leu35Arg$)", None, None),
    ("Amikacin", "rrs", "n.1401A>G n.1402C>T n.1484G>T", None, None, None),
    ("Amikacin", "eis", "c.-14C>T", None, None, None),
    ("Streptomycin", "rrs", "n.514A>C n.517C>T n.1484G>T", None, None, None),
    ("Streptomycin", "rpsL", "p.Lys43Arg p.Lys88Gln p.Lys88Arg", None, None, None),
    ("Ethionamide", "inhA", "p.Ser94Ala", None, None, None),
    ("Ethionamide", "fabG1", "c.-15C>T c.-16A>G c.-8T>C c.-8T>A c.609G>A", None, None, None),
    ("Kanamycin", "rrs", "n.1401A>G n.1402C>T n.1484G>T", None, None, None),
    ("Kanamycin", "eis", "c.-37G>T c.-14C>T c.-12C>T c.-10G>A", None, None, None),
    ("Capreomycin", "rrs", "n.1401A>G n.1402C>T n.1484G>T", None, None, None),
    ("Capreomycin", "tlyA", "p.Asn236Lys", None, None, None),
] + [
    marker
    for drug in ("Levofloxacin", "Moxifloxacin")
    for marker in (
        (
            drug,
            "gyrA",
            "p.Gly88Ala p.Gly88Cys p.Asp89Asn p.Ala90Val p.Ser91Pro "
            "p.Asp94Ala p.Asp94Gly p.Asp94His p.Asp94Asn p.Asp94Tyr",
            None,
            None,
            None,
        ),
        (drug, "gyrB", "p.Ala504Val", None, 1491, 1506),
    )
]
LISTED_EARLIER_DRUGS = ["Pyrazinamide", "Ethambutol", "Rifampicin", "Isoniazid"]

# --------------------------------------------------------------------------- first prediction rules (fixed values)
GENE_DRUGS_V1 = [
    ("katG", "Isoniazid"),
    ("fabG1", "Isoniazid"),
    ("fabG1", "Ethionamide"),
    ("inhA", "Ethionamide"),
    ("ethA", "Ethionamide"),
    ("rpoB", "Rifampicin"),
    ("pncA", "Pyrazinamide"),
    ("gyrA", "Levofloxacin"),
    ("gyrA", "Moxifloxacin"),
    ("gyrB", "Levofloxacin"),
    ("gyrB", "Moxifloxacin"),
    ("tlyA", "Capreomycin"),
    ("ddn", "Delamanid"),
    ("rplC", "Linezolid"),
    ("rpsL", "Streptomycin"),
    ("gid", "Streptomycin"),
    ("embB", "Ethambutol"),
    ("embA", "Ethambutol"),
]
# gene | drug | changes that count for that drug only
CHANGE_DRUGS_V1 = [
    ("eis", "Amikacin", "c.-14C>T"),
    ("eis", "Kanamycin", "c.-14C>T c.-8delC c.-10G>A c.-12C>T c.-37G>T"),
    ("rrs", "Streptomycin", "n.517C>T n.514A>C n.878G>A"),
    ("rrs", "Amikacin", "n.1401A>G n.1402C>T n.1484G>T"),
    ("rrs", "Capreomycin", "n.1401A>G n.1402C>T n.1484G>T"),
    ("rrs", "Kanamycin", "n.1401A>G n.1402C>T n.1484G>T"),
]
_ANY_LOSS = f"({LOSS_PATTERN})"
_NOT_SYNONYMOUS = "^(?!synonymous_variant$)"
_CODING_CHANGE = "^(?!(" + "|".join(FLANKING_EFFECTS + SILENT_EFFECTS) + ")$)"
# gene | effect pattern | accepted changes (empty: any) | refused changes | first codon | last codon
ACCEPT_V1 = [
    ("katG", _ANY_LOSS, "", "", None, None),
    ("katG", "", "p.Ser315Thr p.Ser315Asn p.Trp328Leu", "", None, None),
    ("fabG1", "", "c.-16A>G c.-15C>T c.-8T>C c.-8T>A c.609G>A", "", None, None),
    ("rpoB", _NOT_SYNONYMOUS, "", "", 426, 452),
    ("rpoB", _NOT_SYNONYMOUS, "p.Val170Phe p.Ile491Phe", "", None, None),
    ("pncA", _ANY_LOSS, "", "", None, None),
    ("pncA", "^upstream_gene_variant$", "c.-12T>C c.-11A>G c.-11A>C c.-11A>T c.-7T>C c.-5delG", "", None, None),
    (
        "pncA",
        _CODING_CHANGE,
        "",
        "p.Ile6Leu p.Glu15Gly p.Val21Ala p.Leu35Arg p.Ser66Leu p.Ala79Thr p.Ala79Val p.Thr87Met p.Thr114Met "
        "p.Asp136Asn p.Thr168Ile p.Ala171Val",
        None,
        None,
    ),
    ("eis", "", "c.-14C>T c.-8delC c.-10G>A c.-12C>T c.-37G>T", "", None, None),
    ("rrs", "", "n.1401A>G n.1402C>T n.1484G>T n.517C>T n.514A>C n.878G>A", "", None, None),
    (
        "gyrA",
        "",
        "p.Gly88Cys p.Gly88Ala p.Ala90Val p.Ser91Pro p.Asp94Tyr p.Asp94His p.Asp94Asn p.Asp94Gly p.Asp94Ala",
        "",
        None,
        None,
    ),
    ("gyrB", "", "p.Asp461Asn p.Asn499Asp p.Glu501Val p.Glu501Asp p.Ala504Val", "", None, None),
    ("tlyA", _ANY_LOSS, "", "", None, None),
    ("tlyA", "", "p.Leu74Pro p.Gly232Asp p.Asn236Lys", "", None, None),
    ("ddn", "", "p.Leu49Pro", "", None, None),
    ("rplC", "", "p.Cys154Arg", "", None, None),
    ("rpsL", "", "p.Lys43Arg p.Lys88Arg p.Lys88Met p.Lys88Gln", "", None, None),
    ("gid", _ANY_LOSS, "", "", None, None),
    ("gid", "", "p.Gly69Asp p.Ala134Glu p.Pro75Arg p.Pro84Leu p.Gly73Ala", "", None, None),
    (
        "embB",
        "",
        "p.Met306Val p.Met306Ile p.Gln497Arg p.Asp354Ala p.Gly406Ala p.Tyr319Ser p.Gly406Asp p.Gly406Ser "
        "p.Met306Leu p.Gln497Lys p.Asp328Tyr p.Gly406Cys p.Tyr319Cys p.Leu74Arg",
        "",
        None,
        None,
    ),
    ("embA", "", "c.-12C>T", "", None, None),
    ("ethA", _ANY_LOSS, "", "", None, None),
    (
        "ethA",
        "",
        "p.Thr88Ile p.Arg207Gly c.-7T>C p.Pro378Leu p.Ser390Phe p.Ala341Val p.Ser57Tyr p.Tyr32Asp p.Gly11Val",
        "",
        None,
        None,
    ),
    ("inhA", "", "p.Ser94Ala", "", None, None),
]
# pncA changes that count on their own; every other coding pncA change counts only
# next to rifampicin resistance.
PNCA_DIRECT = """
p.Leu182Trp p.Leu182Ser p.Val180Gly p.Val180Ala p.Ala178_Ser179del p.Val180Phe p.Thr177Pro p.Met175Thr p.Met175Val
p.Leu172Pro p.Leu172Arg p.Thr160_Ala171del p.Ala171Glu p.Thr168Pro p.Ala165del p.Ser164Pro p.Gly162Asp p.Thr160Pro
p.Leu159Arg p.Val155dup p.Val155Gly p.Val155Met p.Arg154Gly p.Leu151Ser p.Ala146Val p.Ala146Thr p.Ala143Gly
p.Thr142Met p.Thr142Lys p.Thr142Ala p.Gln141Pro p.Val139Gly p.Val139Ala p.Val139Leu p.Cys138Arg p.Gly132_Thr135del
p.Thr135Pro p.Thr135Asn p.Ala134Val p.Val128_Val130del p.Ile133Thr p.Val125_Asp129del p.Gly132Ala p.Asp129_Val131del
p.Gly132Asp p.Gly132Ser p.Val131Gly p.Val131Phe p.Asp126_Val130del p.Glu127_Asp129del p.Val130Gly p.Val128Gly
p.Val125Gly p.Val125Phe p.Leu120Pro p.Leu120Arg p.Leu120Gln p.Trp119Cys p.Trp119Gly p.Trp119Arg p.Leu116Pro
p.Leu116Arg p.Ser104_Gly108delinsArg p.Gly108Arg p.Phe106Ser p.Ala102_Gly105del p.Gly105Val p.Gly105Asp p.Ser104Arg
p.Ser104Ile p.Tyr103Cys p.Tyr103Ser p.Tyr103His p.Tyr103Asp p.Ala102Pro p.Gly97Val p.Gly97Asp p.Gly97Cys p.Gly97Arg
p.Gly97Ser p.Lys96delinsAsnLeuAlaIleSerAsnValIleValAspGlyVal p.Lys96Arg p.Lys96Thr p.Lys96Glu p.Lys96Gln p.Phe94Cys
p.Phe94Ser p.Phe94Leu p.Ala89_Ala92dup p.Ile90Thr p.Ile90Ser p.Leu85Arg p.Leu85Pro p.His82Arg p.Phe81Val
p.Ser74_Pro77del p.Thr76Ile p.Thr76Pro p.Cys72Tyr p.Cys72Arg p.His71Pro p.His71Arg p.His71Tyr p.His71Thr p.Pro69Leu
p.Trp68Cys p.Trp68Gly p.Trp68Arg p.Asp63_Ser67delinsGlu p.Gly60_Thr61del p.Ser67Pro p.Ser66del p.Tyr64Asp p.Asp63Gly
p.Asp63Ala p.Pro62_Asp63insAspTyrSer p.Pro62Leu p.Pro62Ser p.Pro62Thr p.Ser59Pro p.Phe58Leu p.His57Arg
p.Pro54_Asp56del p.His57Asp p.His57Tyr p.Gly55del p.Pro54Gln p.Pro54Leu p.His51Gln p.His51Arg p.His51Pro p.His51Asp
p.His51Tyr p.Asp49Glu p.Asp49Ala p.Asp49Gly p.Asp49Asn p.Lys48Thr p.Lys48Glu p.Thr47Pro p.Thr47Ala p.Ala46Glu
p.Ala46Val p.Val44Gly p.Tyr34Asp p.Ile31Ser p.Ile31Thr p.Leu27Pro p.Gly17_Ala25del p.Gly24Asp p.Val21Gly p.Leu19Pro
p.Gly17Asp p.Cys14Arg p.Asp12_Phe13insAlaSerGluProProSerGlnLysSer p.Phe13Leu p.Phe13Ile p.Asp12Glu p.Asp12Gly
p.Asp12Ala p.Asp12Asn p.Gln10His p.Gln10Arg p.Gln10Pro p.Val9Gly p.Asp8Glu p.Asp8Ala p.Asp8Gly p.Asp8Asn p.Val7Gly
p.Leu4_Val7delinsPheIleIle p.Val7Ala p.Val7Leu p.Ile6Thr p.Ala3_Ile5del p.Ile5Ser p.Leu4Trp p.Leu4Ser p.Ala3Glu
""".split()
EXCLUDED_SAMPLE_NAME = "TB03805142"
COVERAGE_LOSS_V1 = [
    ("katG", "Isoniazid"),
    ("pncA", "Pyrazinamide"),
    ("tlyA", "Capreomycin"),
    ("gid", "Streptomycin"),
    ("ethA", "Ethionamide"),
]
UNCOVERED_RRS_DRUGS = ["Amikacin", "Capreomycin", "Kanamycin", "Streptomycin"]
DRUGS_V1 = [
    "Rifampicin",
    "Isoniazid",
    "Pyrazinamide",
    "Amikacin",
    "Capreomycin",
    "Kanamycin",
    "Levofloxacin",
    "Moxifloxacin",
    "Linezolid",
    "Streptomycin",
    "Ethionamide",
    "Ethambutol",
]

# --------------------------------------------------------------------------- second prediction rules (fixed values)
LOSS_OF_FUNCTION_V2 = [
    ("katG", "Isoniazid"),
    ("pncA", "Pyrazinamide"),
    ("Rv0678", "Bedaquiline"),
    ("pepQ", "Bedaquiline"),
    ("Rv0678", "Clofazimine"),
    ("pepQ", "Clofazimine"),
    ("ddn", "Delamanid"),
    ("fbiA", "Delamanid"),
    ("fbiB", "Delamanid"),
    ("fbiC", "Delamanid"),
    ("fgd1", "Delamanid"),
    ("Rv2983", "Delamanid"),
    ("ddn", "Pretomanid"),
    ("fbiA", "Pretomanid"),
    ("fbiB", "Pretomanid"),
    ("fbiC", "Pretomanid"),
    ("fgd1", "Pretomanid"),
    ("Rv2983", "Pretomanid"),
    ("gid", "Streptomycin"),
    ("ethA", "Ethionamide"),
    ("ethA", "Prothionamide"),
    ("tlyA", "Capreomycin"),
]
EPISTASIS_V2 = [("mmpL5", "Bedaquiline"), ("eis", "Amikacin"), ("eis", "Kanamycin")]
COVERAGE_LOSS_V2 = [
    ("katG", "Isoniazid"),
    ("pncA", "Pyrazinamide"),
    ("gid", "Streptomycin"),
    ("ethA", "Ethionamide"),
    ("ethA", "Prothionamide"),
    ("tlyA", "Capreomycin"),
]
UNCALLABLE_V2 = [
    ("rrs", "Amikacin"),
    ("rrs", "Capreomycin"),
    ("rrs", "Kanamycin"),
    ("rrs", "Streptomycin"),
    ("rrl", "Linezolid"),
]
RIBOSOMAL_PREFIXES = ["rrs", "rrl"]
DRUGS_V2 = [
    "Amikacin",
    "Bedaquiline",
    "Capreomycin",
    "Clofazimine",
    "Delamanid",
    "Ethambutol",
    "Ethionamide",
    "Isoniazid",
    "Kanamycin",
    "Levofloxacin",
    "Linezolid",
    "Moxifloxacin",
    "Pretomanid",
    "Prothionamide",
    "Pyrazinamide",
    "Rifampicin",
    "Streptomycin",
]
EXPORT_DRUG_IDS = [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 17, 18]

# --------------------------------------------------------------------------- ingestion (fixed values)
TAXON_REMAP = {1570328: 1795}
EXTERNAL_ARCHIVE = ("ftp://download.big.ac.cn/", "NGDC-CNCB")
SEQUENCING_DEFAULTS = {
    "library_preparation_strategy": "WGS",
    "sequencing_platform": "ILLUMINA",
    "library_layout": "PAIRED",
}
REFUSED_SAMPLE_NAME = "^[SED]RS[0-9]+$"
NO_DATE_RANGES = ["", "[NaT,NaT]", "[0-01-01,0-12-31]"]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, list):
        return f"array({', '.join(_literal(v) for v in value)})"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def rule_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal rule table.  Bounded by this module, hence safe to broadcast.

    Written as VALUES, it is part of the plan: no job has to run to read it.
    """
    columns = [part.strip().split(" ") for part in schema.split(", ")]
    names = ", ".join(f"c{i}" for i in range(len(columns)))
    body = ", ".join(f"({', '.join(_literal(v) for v in row)})" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    typed = [F.col(f"c{i}").cast(kind).alias(name) for i, (name, kind) in enumerate(columns)]
    return F.broadcast(table.select(*typed))


def known_marker_frame(spark: SparkSession) -> DataFrame:
    rows = [(d, g, c.split(), p, lo, hi) for d, g, c, p, lo, hi in KNOWN_MARKERS]
    return rule_frame(
        spark,
        rows,
        "drug_name string, gene_symbol string, changes array<string>, pattern string, first_nt int, last_nt int",
    )


def accept_frame_v1(spark: SparkSession) -> DataFrame:
    rows = [(g, e, c.split(), r.split(), lo, hi) for g, e, c, r, lo, hi in ACCEPT_V1]
    return rule_frame(
        spark,
        rows,
        "gene_name string, effect_like string, changes array<string>, refused array<string>, "
        "first_codon int, last_codon int",
    )


def change_drug_frame_v1(spark: SparkSession) -> DataFrame:
    rows = [(g, d, change) for g, d, changes in CHANGE_DRUGS_V1 for change in changes.split()]
    return rule_frame(spark, rows, "gene_name string, drug string, hgvs_value string")
