"""docforge: document analytics as plain PySpark DataFrame transforms."""
