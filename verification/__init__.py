"""DuckDB SQL that states independently what every registered query returns."""
