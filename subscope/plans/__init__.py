"""The business operators: each module is one product, each function DataFrame to DataFrame."""
