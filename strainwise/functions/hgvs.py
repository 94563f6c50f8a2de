"""Patterns of variant nomenclature texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One amino acid in three-letter code.
RESIDUE = "[A-Z][a-z]{2}"

# Text forms the annotator produces.
STOP_WRITTEN_AS_MISSENSE = rf"^(?!p\.Ter[0-9]+Ter)p\.{RESIDUE}([0-9]+)Ter$"
SINGLE_MISSENSE = rf"^(?!p\.Ter[0-9]+Ter)p\.{RESIDUE}([0-9]+){RESIDUE}$"
SEVERAL_MISSENSE = rf"^p\.({RESIDUE}){{2,}}[0-9]+({RESIDUE}){{2,}}$"
GAINED_STOP = rf"^p\.{RESIDUE}([0-9]+)\*$"
LOST_STOP = rf"^p\.Ter([0-9]+){RESIDUE}$"
SEVERAL_START_LOST = rf"^p\.(Met|Val|Leu|Ile)(?:{RESIDUE})+1\?$"
BARE_POSITION = r"^p\.[0-9]+$"
DELETION_INSERTION = r"c\.[0-9]+_[0-9]+del[AGCT]+ins[AGCT]+"
MISSENSE_ANYWHERE = rf"p\.{RESIDUE}([0-9]+){RESIDUE}"


def after_last_colon(column: Column) -> Column:
    return F.substring_index(column, ":", -1)


def same_length_substitution(reference: Column, alternative: Column) -> Column:
    """True for a multi-nucleotide substitution without insertion or deletion."""
    return (F.length(reference) > 1) & (F.length(reference) == F.length(alternative))
