"""Column-level helpers (pure expressions, JVM-side, codegen friendly)."""

from motifspark.functions.ids import fragment_name, id_part, split_fragment_id
from motifspark.functions.hashing import seeded_key, unit_hash
from motifspark.functions.text import clean_residues, fasta_header, fasta_record, wrap_text

__all__ = [
    "fragment_name", "id_part", "split_fragment_id", "seeded_key", "unit_hash",
    "clean_residues", "fasta_header", "fasta_record", "wrap_text",
]
