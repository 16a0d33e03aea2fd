"""Whole jobs: account and metric registry, forecast job, registered queries."""
