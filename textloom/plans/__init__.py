"""Plans made of several operators: index build, parameter sweep."""
