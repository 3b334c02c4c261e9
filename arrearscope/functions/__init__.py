"""Column expressions: no function here touches a DataFrame."""
