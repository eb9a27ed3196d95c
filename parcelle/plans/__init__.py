"""Jobs composed from the operators: silver, gold, territory, marts, serving."""
