"""SaaS usage and billing analytics written as plain Spark DataFrame functions."""
