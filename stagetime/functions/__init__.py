"""Part of stagetime; see README.md."""
