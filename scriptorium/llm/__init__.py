"""Training-data operators: filters, mixing, near duplicates, decontamination, labels and output.

Nothing outside this subpackage imports it.
"""
