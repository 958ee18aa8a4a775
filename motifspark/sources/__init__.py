"""Readers and writers (FASTA, TSV/CSV tables, ID lists, prediction lists, JSON) and test-table views."""
