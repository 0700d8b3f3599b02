"""Business questions, reports and the query registry built from the operators."""
