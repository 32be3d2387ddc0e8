"""Webshop marts on Spark: load, model, check, diff and report as DataFrame plans."""
