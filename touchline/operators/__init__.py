"""DataFrame operators: page extraction, retry, reshape, log analytics, form and model comparison."""
