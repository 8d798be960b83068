"""DataFrame to DataFrame steps: rules, validation, de-duplication."""
