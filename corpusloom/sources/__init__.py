"""Corpora: folders of text files, very long files, tables, bibliographies."""
