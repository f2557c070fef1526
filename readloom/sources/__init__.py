"""readloom.sources"""
