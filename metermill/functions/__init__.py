"""Column functions: translations, fallbacks, quality codes and text builders."""
