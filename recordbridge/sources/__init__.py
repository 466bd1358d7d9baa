"""Reading dumps and extracts, writing import files."""
