"""Training-data operators: formatting, cleaning, de-duplication, packing."""
