"""tenura: customer-retention analytics as Spark DataFrame operators."""
